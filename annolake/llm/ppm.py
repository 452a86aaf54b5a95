"""Language-model scores by prediction by partial matching over bytes, with a word-unigram base beside it.

The model is the trie of all byte contexts up to ORDER bytes in the training texts, held as a distributed table:
words, the contexts of orders 0, 1 and 2, and those of all longer orders live in hash buckets of their own. Each chunk of texts sends the
counts of its training rows and asks for the contexts and words it holds; a bucket sums what all chunks sent and answers
each with the full list of successors of its contexts. Contexts are read backwards, so that a shorter one is a prefix of a
longer one: the longest grams by their nearest `SHARED` bytes bring every order from there up to one bucket, and are sent once.
The chunk then has the part of the corpus-wide trie that its texts can reach, and walks it from the longest order to the
shortest, two orders in memory at a time. Escape
estimation is method D (half a count of every distinct successor goes to the escape); symbols already seen in a longer context are
excluded from the shorter ones; bytes never seen share what is left evenly. A text's score is the log10
probability of its bytes and of its end, with contexts that begin before the text padded.

Chunks and buckets have a size in bytes of text (`CHUNK_BYTES`, `BUCKET_BYTES`), not in partitions: a task's memory is that of a chunk
or bucket at any size of the corpus. A chunk sends a bucket one row, compressed, and nothing if it has nothing for it.

Defined cases: null and empty texts consist of the end alone; a null doc_id is training data; repeated rows count once each;
a very long text is a chunk of its own size; without training texts all bytes are equally likely; other columns are not
read. What is gathered grows with the corpus: every distinct context of a chunk, of every order, is sent and answered, without caps.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors as an
from . import util, words

ORDER = 5  # a code of ORDER + 1 bytes has to leave 16 bits free
FOLDS, HELD = 7, 2
END = 0xFF  # no byte of UTF-8
SHARED = 3  # nearest context bytes that deal out the grams of this order and longer ones
CHUNK_BYTES, BUCKET_BYTES = 3 << 20, 6 << 20
#: Shares of the buckets: words, the contexts of each order below SHARED, and the longer ones; one bucket each at least.
SHARES = (1 / 8, 0, 1 / 64, 1 / 16, 3 / 4)
LONG = 1 + SHARED


def _shorter(code: np.ndarray, by: int) -> np.ndarray:
    """Grams with their `by` farthest context bytes left out."""
    return code if by == 0 else ((code >> np.uint64(8 * (by + 1))) << np.uint64(8)) | (code & np.uint64(0xFF))


def grams(chunk: an.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Code (context bytes from the nearest to the farthest, then symbol) at every position of every distinct row, and the
    offsets of the rows."""
    n = len(chunk.raw)
    size = np.diff(chunk.offsets)
    offsets = np.concatenate([[0], np.cumsum(size + 1)])
    padded = np.full(int(offsets[-1]) + ORDER * n, END, np.uint8)
    lead = np.arange(n) * (ORDER + 1) + ORDER
    padded[np.arange(len(chunk.data)) + np.repeat(lead, size)] = chunk.data
    code = np.zeros(len(padded) - ORDER, np.uint64) if len(padded) else np.zeros(0, np.uint64)
    for k in [*range(ORDER - 1, -1, -1), ORDER]:
        code = (code << np.uint64(8)) | padded[k : k + len(code)]
    # each row has ORDER pads before it, so its first position is at offset + row * ORDER
    keep = np.arange(int(offsets[-1])) + np.repeat(np.arange(n) * ORDER, size + 1)
    return code[keep], offsets


def tokens(chunk: an.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's lower-cased words, each row's end (0) last, and the offsets of the rows."""
    data = words.lower_ascii(chunk.data)
    starts, ends, first = words.word_spans(data, chunk.offsets)
    h = words.word_hashes(data, starts, ends)
    h[h == 0] = 1
    n = len(chunk.raw)
    out = np.zeros(len(h) + n, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))] = h
    return out, first + np.arange(n + 1)


def _weights(chunk: an.Chunk, held: np.ndarray) -> np.ndarray:
    """How often each distinct row counts as training text."""
    return np.bincount(chunk.of, weights=~held[chunk.order], minlength=len(chunk.raw))


def _runs(ordered: np.ndarray) -> np.ndarray:
    """First position of each distinct value of a sorted array."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _count(values: np.ndarray, offsets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs in training text."""
    ordered = np.sort(values)
    distinct = ordered[_runs(ordered)]
    times = np.repeat(weight.astype(np.int64), np.diff(offsets))
    trained = np.sort(np.repeat(values, times) if weight.max(initial=0) > 1 else values[times > 0])
    first = _runs(trained)
    counts = np.zeros(len(distinct), np.int64)
    counts[np.searchsorted(distinct, trained[first])] = np.diff(np.append(first, len(trained)))
    return distinct, counts


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the number of each position's value."""
    order = np.argsort(values)
    ordered = values[order]
    first = _runs(ordered)
    which = np.empty(len(values), np.int32)
    which[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(values))))
    return ordered[first], which


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with summed counts."""
    by = np.argsort(codes, kind="stable")
    codes = codes[by]
    first = _runs(codes)
    return codes[first], np.add.reduceat(counts[by], first) if len(first) else counts


def _planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes: the planes of high bytes are zeros, which the shuffle's compression removes."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _rising(values: np.ndarray) -> bytes:
    """Ascending numbers, as planes of their differences."""
    return _planes(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts, compressed."""
    raw = _rising(keys) + _planes(counts.astype(np.uint64))
    return struct.pack("<q", len(keys)) + _codec().compress(raw, asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<q", data)
    raw = _codec().decompress(data[8:], 16 * n, asbytes=True)
    return np.cumsum(_numbers(raw[: 8 * n]), dtype=np.uint64), _numbers(raw[8 * n :]).astype(np.int64)


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def find(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in an ascending table (any if it is not there), and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def log10_of(codes: np.ndarray, table: Callable[[int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 P(symbol | context) of each code. table(k): ascending grams of order k and their counts, asked for from the
    longest order down; it has to hold all successors of every context of `codes` that was ever seen in training."""
    n = len(codes)
    out, open_ = np.zeros(n), np.ones(n, bool)
    longer = None  # of the order above: its grams, starts of its contexts, and each code's context, if seen, with its successors
    for k in range(ORDER, -1, -1):
        grams_, counts = table(k)
        start = _runs(grams_ >> np.uint64(8))
        contexts = grams_[start] >> np.uint64(8)
        total = np.append(np.add.reduceat(counts, start) if len(start) else np.zeros(0, np.int64), 0)
        distinct = np.append(np.diff(np.append(start, len(grams_))), 0)
        key = _shorter(codes, ORDER - k)
        at, seen = find(key >> np.uint64(8), contexts)
        at = np.where(seen, at, len(contexts))
        t, q = total[at], distinct[at]
        if longer is not None and len(longer[0]):
            above, begins, at_above, below = longer
            place, known = find(_shorter(above, 1), grams_)
            gone = np.append(np.add.reduceat(np.where(known, counts[place], 0), begins), 0) if len(grams_) else np.zeros(len(begins) + 1, np.int64)
            t, q = t - gone[at_above], q - below
        place, known = find(key, grams_)
        hit = open_ & known
        out[hit] += np.log10((counts[place[hit]] - 0.5) / t[hit])
        open_ &= ~hit
        escape = open_ & seen & (q > 0)
        out[escape] += np.log10(0.5 * q[escape] / t[escape])
        longer = (grams_, start, at, distinct[at])
    out[open_] -= np.log10(np.maximum(1.0, 256 - longer[3][open_]))
    return out


def row_scores(codes: np.ndarray, offsets: np.ndarray, table: Callable[[int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of log10 P over each row's codes. A code takes 48 bits: with the row below it, one plain sort groups equal
    codes, so each distinct one is looked up once and no index has to be sorted along."""
    n = len(offsets) - 1
    out = np.zeros(n)
    parts = []
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        row = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(offsets[lo : hi + 1]))
        both = (codes[offsets[lo] : offsets[hi]] << np.uint64(16)) | row
        both.sort()
        ordered = both >> np.uint64(16)
        first = _runs(ordered)
        parts.append((lo, hi, (both & np.uint64(0xFFFF)).astype(np.uint16), ordered[first], np.diff(np.append(first, len(ordered)))))
    values = log10_of(np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, np.uint64), table)
    at = 0
    for lo, hi, row, distinct, times in parts:
        out[lo:hi] = np.bincount(row, weights=np.repeat(values[at : at + len(distinct)], times), minlength=hi - lo)
        at += len(distinct)
    return out


def _totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


class Buckets:
    """How words (kind 0), the contexts of each short order (kind order + 1) and all longer ones (`LONG`) are dealt to numbered buckets."""

    def __init__(self, total: int):
        self.sizes = [max(1, round(total * s)) for s in SHARES]
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).tolist()

    def kind_of(self, bucket: int) -> int:
        return bisect.bisect_right(self.first, bucket) - 1

    def of_kind(self, kind: int) -> range:
        return range(self.first[kind], self.first[kind + 1])

    def of(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """Buckets of words, or of grams by their context (of long ones: its nearest bytes)."""
        by = keys if kind == 0 else keys >> np.uint64(8 if kind < LONG else 8 * (ORDER + 1 - SHARED))
        return an.bucket_of(words.mix64(by + np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)), self.sizes[kind]) + self.first[kind]


def _successors(contexts: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> bytes:
    """All grams of the given ascending contexts, with their counts."""
    own = codes >> np.uint64(8)
    lo, hi = np.searchsorted(own, contexts), np.searchsorted(own, contexts, side="right")
    size = hi - lo
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return _pack(codes[at], counts[at])


def _dealt(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, keys, counts) of every bucket that has keys; ascending keys stay ascending."""
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    cuts = _runs(bucket)
    for x, y in zip(cuts.tolist(), an.stops(cuts, len(bucket)).tolist(), strict=True):
        yield int(bucket[x]), keys[x:y], counts[x:y]


def language_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and n_bytes for every row."""
    util.small_batches(docs.sparkSession)
    size = util.text_bytes(docs)
    held_out = F.coalesce(util.fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    table = an.keyed(docs.select("doc_id", "text", held_out.alias("__held")), -(-size // chunk_bytes), ["doc_id", "__held"])
    buckets = Buckets(-(-size // bucket_bytes))

    def ask(rows: pa.Table) -> pa.Table:
        chunk = an.Chunk(rows)
        weight = _weights(chunk, np.asarray(rows.column("__held")).astype(bool))
        out: dict[int, bytes] = {}
        word, count = _count(*tokens(chunk), weight)
        for b, keys, counts in _dealt(word, count, buckets.of(word, 0)):
            out[b] = _pack(keys, counts)
        # every chunk asks every bucket of words, as each answer carries the bucket's share of the corpus totals
        none = np.zeros(0, np.int64)
        out |= {b: _pack(none.astype(np.uint64), none) for b in buckets.of_kind(0) if b not in out}
        code, count = _count(*grams(chunk), weight)
        for kind in range(LONG, 0, -1):
            if kind < LONG:
                code, count = _summed(_shorter(code, ORDER - SHARED + 1 if kind == SHARED else 1), count)
            for b, keys, counts in _dealt(code, count, buckets.of(code, kind)):
                out[b] = _pack(keys, counts)
        mine = rows.column("__chunk")[0].as_py()
        return pa.table({"bucket": pa.array(out.keys(), pa.int32()), "chunk": pa.array([mine] * len(out), pa.int32()), "payload": pa.array(out.values(), pa.binary())})

    def answer(rows: pa.Table) -> pa.Table:
        kind = buckets.kind_of(rows.column("bucket")[0].as_py())
        asked = [_unpack(x.as_py()) for x in rows.column("payload")]
        keys = [a[0] for a in asked]
        code, count = _summed(np.concatenate(keys), np.concatenate([a[1] for a in asked]))
        del asked
        replies = []
        if kind == 0:
            # a reply begins with the bucket's distinct words and words in training; then come the counts of what was asked
            share = np.array([(count > 0).sum(), count.sum()], np.uint64)
            for own in keys:
                known = count[np.searchsorted(code, own)]
                replies.append(_pack(np.concatenate([share, np.full(len(known), share[1])]), np.concatenate([[0, 0], known])))
        else:
            code, count = code[count > 0], count[count > 0]
            tables = [(code, count)]  # of long grams: from the longest order down
            for _ in range(ORDER - SHARED if kind == LONG else 0):
                tables.append(_summed(_shorter(tables[-1][0], 1), tables[-1][1]))
            for own in keys:
                contexts = [own >> np.uint64(8 * (k + 1)) for k in range(len(tables))]
                replies.append(an.pack(*(_successors(c[_runs(c)], *t) for c, t in zip(contexts, tables, strict=True))))
        util.tidy()
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "payload": pa.array(replies, pa.binary())})

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return pa.table({f.name: pa.array([], f.type) for f in _OUT})
        chunk = an.Chunk(rows)
        got = dict(zip(answers.column("bucket").to_pylist(), answers.column("payload"), strict=True))
        token, offsets = tokens(chunk)
        word, word_at = _places(token)
        known, all_types, all_tokens = np.zeros(len(word), np.int64), 0, 0
        bucket = buckets.of(word, 0)
        for b in buckets.of_kind(0):
            share, counts = _unpack(got[b].as_py())
            all_types, all_tokens = all_types + int(share[0]), all_tokens + int(share[1])
            known[bucket == b] = counts[2:]
        n_tokens = np.diff(offsets)
        c = known[word_at]
        base = _totals(np.log10(c + 1.0), offsets) - n_tokens * np.log10(all_tokens + 1.0 * (all_types + 1))
        n_known = _totals((c > 0).astype(np.float64), offsets).astype(np.int64)
        del token, word, word_at, c

        def grams_of(k: int) -> tuple[np.ndarray, np.ndarray]:
            kind, at = min(k + 1, LONG), max(0, ORDER - k) if k >= SHARED else 0
            some = [_unpack(an.unpack(got[b].as_py(), *[None] * (ORDER - SHARED + 1 if kind == LONG else 1))[at]) for b in buckets.of_kind(kind) if b in got]
            keys = np.concatenate([np.zeros(0, np.uint64), *(x[0] for x in some)])
            counts = np.concatenate([np.zeros(0, np.int64), *(x[1] for x in some)])
            by = np.argsort(keys, kind="stable")
            return keys[by], counts[by]

        model = row_scores(*grams(chunk), grams_of)
        at = chunk.of
        util.tidy()
        return pa.table(
            {
                "doc_id": rows.column("doc_id").take(pa.array(chunk.order)),
                "held_out": rows.column("__held").take(pa.array(chunk.order)),
                "n_tokens": n_tokens[at],
                "n_known": n_known[at],
                "train_tokens": np.full(len(at), all_tokens, np.int64),
                "base_score": base[at],
                "score": model[at],
                "n_bytes": np.diff(chunk.offsets)[at],
            }
        )

    three = "bucket int, chunk int, payload binary"
    mine = table.groupBy("__chunk")
    answered = mine.applyInArrow(ask, three).groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, payload binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return mine.cogroup(answered.groupBy("chunk")).applyInArrow(score, schema)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()),
    ]
)
