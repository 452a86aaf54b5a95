"""Fill-in-the-middle: texts are cut into prefix, middle and suffix at units chosen by hash, and put together anew.

A text's UTF-8 bytes are cut into blocks of `BLOCK` bytes. For each block the number of units that end in it and of code points that
begin in it are counted, and a Fenwick tree over the blocks stores both. Binary lifting goes down the tree to the block in which the wanted unit
ends and gives the units and code points before that block; the boundary is then found inside the one block. A unit is a code
point, or a match of a pattern: matches go from left to right, what lies between two belongs to the latter, and what follows the last
is a unit of its own. So units tile the text and every cut lies between code points.

The form follows from the id alone (and `seed`), so it is the same in every run and on any partitioning. Rows are independent: no
shuffle, nothing broadcast; memory is that of a few rows' texts.

Defined cases: null texts are empty; empty texts, and texts that hold a control string, stay plain; a null id is hashed as the empty string;
repeated rows and repeated ids are cut alike, each row giving one row; very long texts are cut like any other, whole. Other columns, if
their names are not those of the result, stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import slices, small_batches

BLOCK = 4_096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CONTROL = re.compile(b"<[PSM]>")
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


class Fenwick:
    """Prefix sums of two non-negative counts a block, built in one pass and searched by binary lifting."""

    def __init__(self, units: np.ndarray, chars: np.ndarray):
        self.size = len(units)
        upto = np.zeros((2, self.size + 1), np.int64)
        np.cumsum(units, out=upto[0, 1:])
        np.cumsum(chars, out=upto[1, 1:])
        at = np.arange(self.size + 1)
        self.units, self.chars = upto - upto[:, at - (at & -at)]
        self.top = 1 << self.size.bit_length() >> 1

    def before(self, unit: int) -> tuple[int, int, int]:
        """The block in which the unit-th unit (from 1) ends, and the units and code points before that block."""
        block, rest, chars, step = 0, unit, 0, self.top
        while step:
            nxt = block + step
            if nxt <= self.size and self.units[nxt] < rest:
                block, rest, chars = nxt, rest - int(self.units[nxt]), chars + int(self.chars[nxt])
            step >>= 1
        return block, unit - rest, chars


class Cutter:
    """Finds units' ends in one text. ends: byte offsets at which units end; None: every code point is a unit."""

    def __init__(self, data: bytes, ends: np.ndarray | None, block: int = BLOCK):
        raw = np.frombuffer(data, np.uint8)
        self.block, self.ends, self.length = block, ends, len(raw)
        self.begins = (raw & 0xC0) != 0x80  # bytes that begin a code point
        edges = np.arange(0, max(1, len(raw)), block)
        chars = np.add.reduceat(self.begins, edges, dtype=np.int64) if len(raw) else np.zeros(1, np.int64)
        # a unit that ends at offset e has its last byte at e - 1
        units = chars if ends is None else np.bincount((ends - 1) // block, minlength=len(edges))
        self.n = int(units.sum())
        self.tree = Fenwick(units, chars)

    def cut(self, units: int) -> tuple[int, int]:
        """Byte offset and code points after that many units."""
        if units == 0:
            return 0, 0
        block, done, chars = self.tree.before(units)
        start = block * self.block
        inside = self.begins[start : start + self.block]
        if self.ends is None:  # a code point may go on in the next block
            at = start + int(np.flatnonzero(inside)[units - done - 1]) + 1
            while at < self.length and not self.begins[at]:
                at += 1
            return at, chars + units - done
        first = int(np.searchsorted(self.ends, start, side="right"))
        at = int(self.ends[first + units - done - 1])
        return at, chars + int(self.begins[start:at].sum())


def unit_ends(data: bytes, unit: str | None) -> np.ndarray | None:
    """Byte offsets at which the units of a text end; None if each code point is one."""
    if unit is None:
        return None
    text = data.decode("utf-8", "surrogateescape")
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000) - 2 * ((code >= 0xDC80) & (code < 0xDD00))))
    ends = {int(size[m.end()]) for m in regex.finditer(unit, text) if m.end() > m.start()}
    return np.array(sorted(ends | ({len(data)} if data else set())), np.int64)


def chances(doc_id: int | None, seed: int) -> list[int]:
    """The first four groups of eight digits of the sha256 of `seed:id`."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def arranged(data: bytes, doc_id: int | None, seed: int, unit: str | None, plain_from: int, spm_below: int) -> tuple:
    """(units, form, prefix_chars, middle_chars, output) of a text."""
    cutter = Cutter(data, unit_ends(data, unit))
    n = cutter.n
    a, b, plain, spm = chances(doc_id, seed)
    if not data or plain % 100 >= plain_from or CONTROL.search(data):
        return n, "plain", None, None, data
    (one, one_chars), (two, two_chars) = (cutter.cut(k) for k in sorted((a % (n + 1), b % (n + 1))))
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    prefix, middle, suffix = data[:one], data[one:two], data[two:]
    spm_form = spm % 100 < spm_below
    parts = (s, suffix, p, prefix, m, middle) if spm_form else (p, prefix, s, suffix, m, middle)
    return n, "spm" if spm_form else "psm", one_chars, two_chars - one_chars, b"".join(parts)


def fill_in_middle(docs: DataFrame, seed: int = 1, unit: str | None = None, plain_from: int = 90, spm_below: int = 20, keep: list[str] | None = None) -> DataFrame:
    """The rows of `docs` (of its columns `keep`, if given) with n, form, prefix_chars, middle_chars and output. `unit`: a pattern, or
    None for code points. In a hundred, `plain_from` texts are cut, of which `spm_below` in a hundred put the suffix first."""
    small_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    fields = {f.name: f for f in docs.schema}
    out = ", ".join([*(f"`{c}` {fields[c].dataType.simpleString()}" for c in kept), "n long, form string, prefix_chars long, middle_chars long, output binary"])
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "__text"):
                found = [arranged(t or b"", i, seed, unit, plain_from, spm_below) for i, t in zip(b.column("__id").to_pylist(), b.column("__text").to_pylist(), strict=True)]
                added = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *added], names=[*kept, *ADDED])

    asked = docs.select(*(F.col(f"`{c}`") for c in kept), F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("binary").alias("__text"))
    return asked.mapInArrow(rows, out).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text of an output. The control strings share no character at their ends, so none arises where pieces meet."""
    part = F.split(output, "<[PSM]>")
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, **options: object) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text restored from it."""
    made = fill_in_middle(docs, keep=["doc_id"], **options)
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
