"""Exact search for repeated windows in a corpus, by local-minimum anchors.

A window is `size` consecutive units (bytes or words) of one text. Among the window's grams of `gram` units, the one
of least hash (leftmost among equals) is its anchor, so equal windows have equal anchors at equal distance. Only
windows whose anchor occurs more than once can occur more than once themselves.

Texts are read in chunks of about `CHUNK_BYTES` (by a hash of the row's key), which a single shuffle deals out and Spark
reuses. A chunk asks for keys (anchors, say): it sends each distinct key once, however often it holds it, to a hash bucket of
about `BUCKET_BYTES` of the corpus; the bucket answers with how it stands in the corpus, and the chunk goes on with what is
left. So the most frequent line of a corpus costs one entry a chunk, rows of a key never gather in one task, and the memory
of a task is that of one chunk or bucket at any size of the corpus. Rows with the same id and text share a chunk.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import util

INDEX_BITS = 24
MASK = np.uint64((1 << INDEX_BITS) - 1)
MOST_UNITS = 1 << INDEX_BITS


def pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    return struct.pack(f"<{len(parts) + 1}q", len(parts), *map(len, parts)) + b"".join(parts)


def unpack(data: bytes, *dtypes: str | None) -> list:
    (n,) = struct.unpack_from("<q", data)
    sizes = struct.unpack_from(f"<{n}q", data, 8)
    at, out = 8 * (n + 1), []
    for size, dtype in zip(sizes, dtypes, strict=True):
        out.append(data[at : at + size] if dtype is None else np.frombuffer(data, dtype, size // np.dtype(dtype).itemsize, at))
        at += size
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    span, out = 1, x
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchor_runs(h: np.ndarray, window_ok: np.ndarray, grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start of every run of windows with the same anchor.

    h: a hash for each gram; window_ok: for each window start, whether the window lies within one text;
    grams: how many grams a window has.
    """
    if len(window_ok) == 0 or not window_ok.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    found = []
    step = MOST_UNITS - grams
    for base in range(0, len(window_ok), step):
        part = h[base : base + step + grams - 1]
        key = (part & ~MASK) | np.arange(len(part), dtype=np.uint64)
        at = (sliding_min(key, grams) & MASK).astype(np.int64) + base
        ok = window_ok[base : base + step]
        at = np.where(ok, at[: len(ok)], -1)
        edges = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        lasts = np.concatenate([edges[1:], [len(at)]]) - 1
        keep = at[edges] >= 0
        found.append((at[edges][keep], edges[keep] + base, lasts[keep] + base))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 6 << 20


def keyed(docs: DataFrame, chunks: int, keep: list[str]) -> DataFrame:
    """Rows with their key (k0: has an id, k1: the id, h: a hash of the text), chunk and text in bytes; every pass reads this table."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(*keep, F.col("doc_id").isNotNull().cast("int").alias("__k0"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("__k1"), text.alias("__text"))
    rows = rows.withColumn("__h", F.xxhash64("__text"))
    return rows.withColumn("__chunk", F.pmod(F.xxhash64("__k0", "__k1", "__h"), F.lit(chunks)).cast("int"))


def runs_of(*ordered: np.ndarray) -> np.ndarray:
    """First position of each distinct row of columns that are sorted together."""
    new = np.ones(len(ordered[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in ordered])
    return np.flatnonzero(new)


def grouped(columns: list[np.ndarray]) -> np.ndarray:
    """An order by one or two columns; equal rows come in any order."""
    order = np.argsort(columns[0])
    if len(columns) > 1:  # rarely are rows equal in the first column alone
        x, y = (c[order] for c in columns)
        if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
            return np.lexsort(columns[::-1])
    return order


def stops(first: np.ndarray, n: int) -> np.ndarray:
    """Where the runs that begin at `first` end, in n rows."""
    return np.append(first[1:], n)[: len(first)]


class Chunk:
    """Distinct rows of a chunk, sorted by key, as flat bytes. Rows are one only if their texts are equal byte by byte."""

    def __init__(self, rows: pa.Table):
        key = [np.asarray(rows.column(c)) for c in ("__k0", "__k1", "__h")]
        texts = rows.column("__text")
        self.order = np.lexsort(key[::-1])
        first = runs_of(*(k[self.order] for k in key))
        sizes = stops(first, len(self.order)) - first
        new = np.zeros(len(self.order), bool)
        new[first] = True
        for x, n in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            own = self.order[x : x + n]
            raw = [texts[int(i)].as_py() for i in own]
            if any(r != raw[0] for r in raw):  # one key, several texts: a collision of 64-bit hashes
                by = sorted(range(n), key=raw.__getitem__)
                self.order[x : x + n] = own[by]
                new[x + 1 : x + n] = [raw[i] != raw[j] for i, j in zip(by[1:], by, strict=False)]
        #: for each row in order, the number of its distinct row
        self.of = np.cumsum(new) - 1
        self.key = [k[self.order[new]].astype(np.int64) for k in key]
        self.copies = np.bincount(self.of) if len(self.of) else np.zeros(0, np.int64)
        self.raw = [texts[int(i)].as_py() for i in self.order[new]]
        lengths = np.array([len(t) for t in self.raw], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(self.raw), np.uint8)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, ascending positions) of every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    first = runs_of(bucket[order])
    for x, y in zip(first.tolist(), stops(first, len(order)).tolist(), strict=True):
        yield int(bucket[order[x]]), order[x:y]


class Keys:
    """Distinct keys of a chunk (one or two 64-bit columns), and how often it holds each."""

    def __init__(self, columns: list[np.ndarray], times: np.ndarray):
        order = grouped(columns)
        columns = [c[order] for c in columns]
        first = runs_of(*columns)
        self.columns = [c[first] for c in columns]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(first)), stops(first, len(order)) - first)
        self.times = np.bincount(self.of, times, minlength=len(first)).astype(np.int64)

    def ask(self, chunk: int, buckets: int, kind: int) -> pa.Table:
        """A row for each bucket: its keys, and how often the chunk has each."""
        to, out = [], []
        for b, at in dealt(bucket_of(self.columns[0], buckets)):
            to.append(b)
            out.append(pack(self.times[at].astype("<u4"), *(c[at] for c in self.columns)))
        return pa.table({"kind": pa.array([kind] * len(to), pa.int32()), "bucket": pa.array(to, pa.int32()), "chunk": pa.array([chunk] * len(to), pa.int32()), "payload": pa.array(out, pa.binary())})

    def answered(self, answers: pa.Table, buckets: int, kind: int, what: int = 0) -> np.ndarray:
        """For each position that had a key: the answer (0: more than once in the corpus, 1: more than `hot` times, 2: this chunk is the key's own)."""
        own = np.zeros(len(self.columns[0]), bool)
        got = {b: x for k, b, x in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "payload")), strict=True) if k == kind}
        for b, at in dealt(bucket_of(self.columns[0], buckets)):
            size = -(-len(at) // 8)
            own[at] = np.unpackbits(np.frombuffer(got[b], np.uint8, size, what * size), count=len(at)).astype(bool)
        return own[self.of]


ASKED = "kind int, bucket int, chunk int, payload binary"
ASKED_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary())])


def answered(asked: DataFrame, hot: int = 1 << 60, own: bool = False) -> DataFrame:
    """The buckets' answers to what chunks asked: two bits for each key, whether it occurs more than once, and more than `hot` times; with
    `own` a third, which one chunk of all that hold the key gets, the first in a random order of chunks."""

    def answer(rows: pa.Table) -> pa.Table:
        got = [unpack(x.as_py(), "<u4", *["<u8"] * (struct.unpack_from("<q", x.as_py())[0] - 1)) for x in rows.column("payload")]
        times, *columns = (np.concatenate(x) for x in zip(*got, strict=True))
        order = grouped(columns)
        first = runs_of(*(c[order] for c in columns))
        total = np.empty(len(order), np.int64)
        total[order] = np.repeat(np.add.reduceat(times[order].astype(np.int64), first), stops(first, len(order)) - first)
        ends = np.cumsum([0, *(len(g[0]) for g in got)]).tolist()
        bits = [total > 1, total > hot]
        if own:
            place = np.empty(len(got), np.int64)
            place[np.argsort(util.mix64(np.asarray(rows.column("chunk")).astype(np.uint64) + np.uint64(1)))] = np.arange(len(got))
            holder = np.repeat(place, np.diff(ends))
            least = np.empty(len(order), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(holder[order], first), stops(first, len(order)) - first)
            bits.append(holder == least)
        out = [b"".join(np.packbits(b[x:y]).tobytes() for b in bits) for x, y in zip(ends[:-1], ends[1:], strict=True)]
        util.tidy()
        return pa.table({"kind": rows.column("kind"), "bucket": rows.column("bucket"), "chunk": rows.column("chunk"), "payload": pa.array(out, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(answer, ASKED)


#: The removed spans of a row.
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def union(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by half-open intervals; touching ones are one run."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
