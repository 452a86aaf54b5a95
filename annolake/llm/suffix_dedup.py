"""Substring deduplication: bytes inside a 100-byte string that also starts earlier are removed.

Windows of `SIZE` bytes are found by their anchors (see anchors.py). Suffixes that start at equal anchors meet in one
bucket, where they are sorted: multikey quicksort, with eight bytes as one character, orders them to a shallow
depth (the anchor's gram); a blind trie per group of equal grams orders the rest, which shares long prefixes, with one comparison of
bytes for each suffix. A node of the trie groups the suffixes with a common prefix; among them, the
longest common left context with any earlier suffix tells which of an entry's windows started earlier.

An anchor that occurs more than `HOT` times is split: the windows at it are dealt by their whole content (128-bit keys), each
chunk sending each distinct one once, with its first start. So no bucket gathers a frequent line's rows, whatever stands around it.

Defined cases: null text is empty; texts shorter than SIZE keep every byte; rows are ordered by doc_id (null first), then
by a hash of the text, then by the text; of several rows with the same id and text the first stays and the others lose all
bytes if they have SIZE or more; matches never cross rows; very long texts are cut nowhere; other columns are not read.
Strings are judged on the input.
"""

from __future__ import annotations

import bisect
import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import anchors as an
from . import util
from .util import mix64
from .words import _BASE, _BYTE, _STEP, powers

SIZE = 100
GRAM = 40
DEPTH = GRAM // 8
SMALL = 24
HOT = 8192
ANCHORS, PIECES, WHOLE, OWN = 0, 1, 2, 3


class Entries:
    """What a bucket has received: pieces of text around equal anchors, as entries that point to distinct pieces."""

    def __init__(self, payloads: list[bytes]):
        parts = [an.unpack(x, "<i4", "<i8", "<i8", "<i8", "<i4", "<i8", "<i8", "<i8", "<i4", "<i8", None) for x in payloads]
        self.source = np.repeat(np.arange(len(parts)), [len(p[4]) for p in parts])
        rows = np.cumsum([0, *(len(p[0]) for p in parts)])
        at = np.concatenate([p[4] + base for p, base in zip(parts, rows.tolist(), strict=False)])
        #: number of the row in its chunk, and the key of its order
        self.row, *self.key = (np.concatenate([p[i] for p in parts])[at] for i in range(4))
        self.pos, self.first, self.last = (np.concatenate([p[i] for p in parts]) for i in (5, 6, 7))
        number: dict[tuple[int, bytes], int] = {}
        piece = []
        for p in parts:
            ends = np.concatenate([[0], np.cumsum(p[9])]).tolist()
            own = [p[10][x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
            for k, off in zip(p[8].tolist(), (p[5] - p[6]).tolist(), strict=True):
                piece.append(number.setdefault((off, own[k]), len(number)))
        #: the distinct pieces, as (units before the anchor, bytes), and each entry's piece
        self.pieces = list(number)
        self.piece = np.array(piece, dtype=np.int64)
        #: order of the entries in the corpus
        self.rank = np.empty(len(at), np.int64)
        self.rank[np.lexsort((self.pos, self.row, *self.key[::-1]))] = np.arange(len(at))


def _rows_of(chunk: an.Chunk, row: np.ndarray) -> list[np.ndarray]:
    """The rows that occur in `row`, their keys, and the place of each value of `row` among them."""
    rows, which = np.unique(row, return_inverse=True)
    return [rows.astype(np.int32), *(k[rows] for k in chunk.key), which.astype(np.int32)]


def pieces(chunk: an.Chunk, runs_: tuple, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, payload) with the text of every run; equal pieces of a bucket are sent once."""
    hashes, row, pos, first, last = runs_
    texts = cut(chunk, runs_)
    for b, at in an.dealt(an.bucket_of(hashes, buckets)):
        number: dict[tuple[int, bytes], int] = {}
        which = np.array([number.setdefault((off, texts[i]), len(number)) for i, off in zip(at.tolist(), (pos - first)[at].tolist(), strict=True)], np.int32)
        own = [t for _, t in number]
        yield b, an.pack(*_rows_of(chunk, row[at]), pos[at], first[at], last[at], which, np.array([len(t) for t in own], np.int64), b"".join(own))


def settle_pieces(payloads: list[bytes]) -> list[bytes]:
    """For each payload the intervals (row, from, to) that windows which start earlier cover."""
    entries = Entries(payloads)
    e, a, b = compare(entries)
    order = np.argsort(entries.source[e], kind="stable")
    e, a, b = e[order], a[order], b[order]
    cuts = np.searchsorted(entries.source[e], np.arange(len(payloads) + 1)).tolist()
    return [an.pack(entries.row[e[x:y]].astype(np.int32), a[x:y].astype(np.int64), b[x:y].astype(np.int64)) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def covered(row: np.ndarray, pos: np.ndarray) -> bytes:
    """Intervals (row, from, to) that windows at the given starts cover, packed."""
    order = np.lexsort((pos, row))
    row, pos = row[order], pos[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (np.diff(pos) > SIZE))) if len(row) else np.zeros(0, np.int64)
    return an.pack(row[first].astype(np.int32), pos[first].astype(np.int64), pos[an.stops(first, len(row)) - 1].astype(np.int64) + SIZE)


class Whole:
    """Windows at frequent anchors, keyed by two hashes of all their bytes."""

    def __init__(self, chunk: an.Chunk, runs_: tuple):
        _, self.row, _, first, last = runs_
        size = last - first + 1
        self.row = np.repeat(self.row, size)
        self.pos = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        flat = chunk.offsets[self.row] + self.pos
        by = np.argsort(flat, kind="stable")  # in the order of the corpus
        self.row, self.pos, flat = self.row[by], self.pos[by], flat[by]
        self.keys = an.Keys([window_hashes(chunk.data, flat, base) for base in (_BASE, _STEP)], np.ones(len(flat)))
        #: the first window of each key
        self.start = np.full(len(self.keys.columns[0]), len(flat), np.int64)
        np.minimum.at(self.start, self.keys.of, np.arange(len(flat)))

    def ask(self, chunk: an.Chunk, buckets: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, payload) with each distinct window's first start."""
        for b, at in an.dealt(an.bucket_of(self.keys.columns[0], buckets)):
            first = self.start[at]
            yield b, an.pack(*_rows_of(chunk, self.row[first]), self.pos[first], *(c[at] for c in self.keys.columns))

    def again(self) -> bytes:
        """What windows cover that also start earlier in the chunk itself."""
        later = np.ones(len(self.row), bool)
        later[self.start] = False
        return covered(self.row[later], self.pos[later])


def settle_whole(payloads: list[bytes]) -> list[bytes]:
    """For each payload the intervals (row, from, to) that its windows cover which start earlier in another chunk."""
    parts = [an.unpack(x, "<i4", "<i8", "<i8", "<i8", "<i4", "<i8", "<u8", "<u8") for x in payloads]
    base = np.cumsum([0, *(len(p[0]) for p in parts)]).tolist()
    at = np.concatenate([p[4] + x for p, x in zip(parts, base, strict=False)])
    row, *key = (np.concatenate([p[i] for p in parts])[at] for i in range(4))
    pos, *columns = (np.concatenate([p[i] for p in parts]) for i in (5, 6, 7))
    order = np.lexsort((pos, row, *key[::-1], *columns[::-1]))
    later = np.ones(len(order), bool)
    later[order[an.runs_of(*(c[order] for c in columns))]] = False
    ends = np.cumsum([0, *(len(p[4]) for p in parts)]).tolist()
    return [covered(row[x:y][later[x:y]], pos[x:y][later[x:y]]) for x, y in zip(ends[:-1], ends[1:], strict=True)]


def window_hashes(data: np.ndarray, at: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of the SIZE bytes from each of the positions: a difference of two sums of bytes times powers, brought to one power."""
    if not len(at):
        return np.zeros(0, np.uint64)
    up = powers(len(data), base)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(_BYTE ^ base)[data] * up, dtype=np.uint64)])
    down = powers(len(data), np.uint64(pow(int(base), -1, 2**64)))
    return mix64((sums[at + SIZE] - sums[at]) * down[at])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling; GRAM = 32 + 8."""
    h = _BYTE[data]
    eight = None
    span, factor = 1, int(_BASE)
    while span < 32:
        h = h[:-span] * np.uint64(factor) + h[span:]
        span, factor = span * 2, factor * factor & (2**64 - 1)
        if span == 8:
            eight, by_eight = h, np.uint64(factor)
    n = len(data) - GRAM + 1
    return mix64(h[:n] * by_eight + eight[32 : 32 + n])


def runs(chunk: an.Chunk) -> tuple:
    """(hash, row, anchor, first, last) of every run of windows; positions within the row's text."""
    if len(chunk.data) < SIZE:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    h = gram_hashes(chunk.data)
    ok = np.zeros(len(chunk.data) - SIZE + 2, np.int32)
    long = np.diff(chunk.offsets) >= SIZE
    np.add.at(ok, chunk.offsets[:-1][long], 1)
    np.add.at(ok, chunk.offsets[1:][long] - SIZE + 1, -1)
    at, first, last = an.anchor_runs(h, np.cumsum(ok[:-1]) > 0, SIZE - GRAM + 1)
    row = np.searchsorted(chunk.offsets, at, side="right") - 1
    base = chunk.offsets[row]
    return h[at], row, at - base, first - base, last - base


def cut(chunk: an.Chunk, found: tuple) -> list[bytes]:
    _, row, _, first, last = found
    return [chunk.raw[r][a : b + SIZE] for r, a, b in zip(row.tolist(), first.tolist(), last.tolist(), strict=True)]


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def multikey_quicksort(chars: np.ndarray) -> list[np.ndarray]:
    """Rows of an n x DEPTH matrix in order, as groups of equal rows."""
    out: list[np.ndarray] = []
    rng = random.Random(5)
    todo = [(np.arange(len(chars)), 0)]
    while todo:
        idx, d = todo.pop()
        if len(idx) == 0:
            continue
        if d == chars.shape[1] or len(idx) == 1:
            out.append(idx)
            continue
        if len(idx) <= SMALL:
            keys = list(map(tuple, chars[idx, d:].tolist()))
            order = sorted(range(len(idx)), key=keys.__getitem__)
            start = 0
            for k in range(1, len(order) + 1):
                if k == len(order) or keys[order[k]] != keys[order[start]]:
                    out.append(idx[order[start:k]])
                    start = k
            continue
        c = chars[idx, d]
        pivot = sorted(int(c[rng.randrange(len(c))]) for _ in range(5))[2]
        todo += [(idx[c > pivot], d), (idx[c == pivot], d + 1), (idx[c < pivot], d)]
    return out


class Node:
    __slots__ = ("depth", "ids", "kids", "sample")

    def __init__(self, depth: int, sample: bytes, ids: list[int] | None = None):
        self.depth, self.sample, self.ids = depth, sample, ids or []
        self.kids: dict[int, Node] = {}


def blind_trie(suffixes: list[bytes], members: list[int], depth: int) -> Node:
    """Trie of the members' suffixes, which share `depth` bytes: branching bytes only, one comparison each."""
    root = Node(depth, suffixes[members[0]])
    for i in members:
        s = suffixes[i]
        path, node = [root], root
        while node.depth < len(s) and (below := node.kids.get(s[node.depth])) is not None:
            node = below
            path.append(node)
        shared = common(s, node.sample)
        k = len(path) - 1
        while path[k].depth > shared:
            k -= 1
        at = path[k]
        if at.depth < shared:
            under = path[k + 1] if k + 1 < len(path) else None
            middle = Node(shared, s)
            if under is not None:
                middle.kids[under.sample[shared]] = under
            at.kids[s[at.depth]] = middle
            at = middle
        if at.depth == len(s):
            at.ids.append(i)
        else:
            at.kids[s[at.depth]] = Node(len(s), s, [i])
    return root


def earlier_left(order: list[int], left: list[bytes]) -> list[int]:
    """For each member in order of position: the most bytes that its left context shares with an earlier one's."""
    seen: list[bytes] = []
    out = []
    for i in order:
        k = bisect.bisect_left(seen, left[i])
        most = -1
        if k < len(seen):
            most = common(left[i], seen[k])
        if k:
            most = max(most, common(left[i], seen[k - 1]))
        seen.insert(k, left[i])
        out.append(most)
    return out


def _group(members: list[int], right: list[bytes], left: list[bytes], rank: np.ndarray, note) -> None:
    """Report, for pieces with one gram, the windows (by their bytes before the anchor) that started earlier."""
    root = blind_trie(right, members, GRAM)
    # members below each node, deepest first
    todo, post = [(root, GRAM - 1)], []
    while todo:
        node, above = todo.pop()
        post.append((node, above))
        todo += [(kid, node.depth) for kid in node.kids.values()]
    below: dict[int, list[int]] = {}
    for node, above in reversed(post):
        ids = list(node.ids)
        for kid in node.kids.values():
            ids += below.pop(id(kid))
        below[id(node)] = ids
        # windows with l bytes before the anchor have SIZE - l after it: those between this node and the one above
        lo, hi = SIZE - node.depth, SIZE - above - 1
        if len(ids) > 1 and hi >= lo:
            ids.sort(key=rank.__getitem__)
            for i, most in zip(ids, earlier_left(ids, left), strict=True):
                if most >= lo:
                    note(i, lo, min(hi, most))


def compare(entries: an.Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of bytes that are covered by windows which also start earlier."""
    # equal pieces: all but the first entry are covered whole
    order = np.lexsort((entries.rank, entries.piece))
    head = np.ones(len(order), bool)
    head[1:] = entries.piece[order[1:]] != entries.piece[order[:-1]]
    firsts, rest = order[head], order[~head]
    e, a, b = [rest], [entries.first[rest]], [entries.last[rest] + SIZE]
    # firsts[p] is the first entry of piece p
    right = [t[off:] for off, t in entries.pieces]
    left = [t[:off][::-1] for off, t in entries.pieces]
    rank = np.empty(len(firsts), np.int64)
    rank[np.argsort(entries.rank[firsts])] = np.arange(len(firsts))
    chars = np.frombuffer(b"".join(r[:GRAM] for r in right), ">u8").reshape(-1, DEPTH) if right else np.zeros((0, DEPTH), np.uint64)
    marks: list[tuple[int, int, int]] = []
    for group in multikey_quicksort(chars):
        if len(group) > 1:
            _group(group.tolist(), right, left, rank, lambda i, lo, hi: marks.append((i, lo, hi)))
    if marks:
        m = np.array(marks, dtype=np.int64)
        at = firsts[m[:, 0]]
        e.append(at)
        a.append(entries.pos[at] - m[:, 2])
        b.append(entries.pos[at] - m[:, 1] + SIZE)
    return np.concatenate(e), np.concatenate(a), np.concatenate(b)


def _finish(chunk: an.Chunk, by: dict, rows: pa.Table) -> pa.Table:
    results = []
    for r, raw in enumerate(chunk.raw):
        spans = an.union(by.get(r, []))
        kept, at = hashlib.sha256(), 0
        for x, y in spans:
            kept.update(raw[at:x])
            at = y
        kept.update(raw[at:])
        results.append((len(raw), sum(y - x for x, y in spans), len(spans), kept.hexdigest(), spans))
    out = []
    seen = -1
    for r in chunk.of.tolist():
        n, removed, spans, kept, runs_ = results[r]
        if r == seen and n >= SIZE:
            removed, spans, kept, runs_ = n, 1, hashlib.sha256().hexdigest(), [(0, n)]
        seen = r
        out.append((n, removed, spans, kept, [{"start": x, "stop": y} for x, y in runs_]))
    cols = list(zip(*out, strict=True)) if out else [[]] * 5
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), an.SPANS]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return pa.table([rows.column("doc_id").take(pa.array(chunk.order)), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *names])


def removed_spans(docs: DataFrame, chunk_bytes: int = an.CHUNK_BYTES, bucket_bytes: int = an.BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every row."""
    util.small_batches(docs.sparkSession)
    size = util.text_bytes(docs)
    buckets = -(-size // bucket_bytes)
    table = an.keyed(docs, -(-size // chunk_bytes), ["doc_id"])

    def asked(found: tuple) -> an.Keys:
        return an.Keys([found[0]], np.ones(len(found[0])))

    def chosen(found: tuple, answers: pa.Table) -> tuple[tuple, tuple]:
        """Runs at anchors that occur more than once: those to compare as pieces, and those to split into windows."""
        keys = asked(found)
        more, many = (keys.answered(answers, buckets, ANCHORS, what) for what in (0, 1))
        return tuple(x[more & ~many] for x in found), tuple(x[many] for x in found)

    def ask(rows: pa.Table) -> pa.Table:
        return asked(runs(an.Chunk(rows))).ask(rows.column("__chunk")[0].as_py(), buckets, ANCHORS)

    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return an.ASKED_SCHEMA.empty_table()
        chunk = an.Chunk(rows)
        some, many = chosen(runs(chunk), answers)
        out = [(PIECES, b, x) for b, x in pieces(chunk, some, buckets)]
        mine = rows.column("__chunk")[0].as_py()
        if len(many[0]):
            windows = Whole(chunk, many)
            out += [(WHOLE, b, x) for b, x in windows.ask(chunk, buckets)]
            out.append((OWN, mine, windows.again()))
        kind, bucket, payload = zip(*out, strict=True) if out else ([], [], [])
        util.tidy()
        return pa.Table.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array([mine] * len(out), pa.int32()), pa.array(payload, pa.binary())], schema=an.ASKED_SCHEMA)

    def settle(rows: pa.Table) -> pa.Table:
        kind, payloads = rows.column("kind")[0].as_py(), [x.as_py() for x in rows.column("payload")]
        out = payloads if kind == OWN else (settle_pieces if kind == PIECES else settle_whole)(payloads)
        util.tidy()
        return pa.Table.from_arrays([rows.column("kind"), rows.column("bucket"), rows.column("chunk"), pa.array(out, pa.binary())], schema=an.ASKED_SCHEMA)

    def apply(rows: pa.Table, marks: pa.Table) -> pa.Table:
        by: dict[int, list[tuple[int, int]]] = {}
        for x in marks.column("payload"):
            for r, start, stop in zip(*(y.tolist() for y in an.unpack(x.as_py(), "<i4", "<i8", "<i8")), strict=True):
                by.setdefault(r, []).append((start, stop))
        return _finish(an.Chunk(rows), by, rows)

    mine = table.groupBy("__chunk")
    of_anchors = an.answered(mine.applyInArrow(ask, an.ASKED), hot)
    sent = mine.cogroup(of_anchors.groupBy("chunk")).applyInArrow(send, an.ASKED)
    settled = sent.groupBy("kind", "bucket").applyInArrow(settle, an.ASKED)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, stop: long>>"
    return mine.cogroup(settled.groupBy("chunk")).applyInArrow(apply, schema)
