"""Byte-level BPE by corpus-level merge replay, and decoding.

The texts of a slice of a partition (`SLICE_BYTES`) are split by the tokenizer's pattern; every distinct piece has a number, and
a text is kept as its pieces' numbers. Distinct pieces that are new and no tokens themselves are laid end to end; an inverted index maps the rank of every adjacent token pair to its positions. Ranks are replayed in
ascending order: every position of the pair, left to right, is merged, and only the two touched neighbours are
looked up again. A merge that opens a pair of lower rank hands over to that pair at once, so each piece sees the
same order of merges as when it is encoded alone. The work is partition-local: no shuffle, and the piece cache of
a worker is bounded (when full it is emptied; it only saves time).

Defined cases: null and empty texts have no tokens (digests of the empty string); white space, control characters and
strings that look like special tokens are ordinary text; repeated rows are encoded alike; other columns are not
read. The rank file's path is a parameter; every executor reads it from its own installation.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import util

SLICE_BYTES = 4 << 20
CACHE_PIECES = 150_000
REPLAY_PIECES = 80_000


class Numbers(dict):
    """Numbers of pieces; a new one gets the next."""

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        return n


class Ranks:
    """A rank file: token bytes to id, and the rank of each pair of ids that may merge."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.text = [b""] * (1 + max(self.ids.values()))
        for token, i in self.ids.items():
            self.text[i] = token
        self.byte = [self.ids[bytes([b])] for b in range(256)]
        # a pair's key is its two ids; sorted arrays take a tenth of a dictionary's memory in every worker
        keys, ranks = array("q"), array("q")
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    ranks.append(i)
        order = np.argsort(np.frombuffer(keys, np.int64))
        self.pair_keys, self.pair_ranks = np.frombuffer(keys, np.int64)[order], np.frombuffer(ranks, np.int64)[order]
        #: rank of each pair of single bytes, -1 if there is none
        own = np.array(self.byte)
        self.of_bytes = self.rank_of(np.repeat(own, 256), np.tile(own, 256)).reshape(256, 256)
        self.numbers, self.encoded = Numbers(), []

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where there is none (a negative id has none)."""
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], -1)

    def replay(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each piece: all positions of a rank are merged at once.

        A merge may open a pair of lower rank in its piece, which has to come first. Such pieces are put aside
        and replayed position by position.
        """
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        n = int(starts[-1])
        if n < 2:
            return [b""] * len(pieces)
        inner = np.ones(n, bool)
        inner[starts[1:] - 1] = False  # no merge crosses the -1 after each piece
        tok = np.full(n, -1, dtype=np.int64)
        tok[inner] = np.array(self.byte)[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[-1] = n - 1
        index: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def note(r: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(r, kind="stable")
            r, at = r[order], at[order]
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if (k := int(r[lo])) in index:
                    index[k].append(at[lo:hi])
                else:
                    index[k] = [at[lo:hi]]
                    heapq.heappush(ranks, k)

        first = self.rank_of(tok[:-1], tok[1:])
        at = np.flatnonzero(first >= 0)
        if len(at):
            note(first[at], at)
        aside: list[np.ndarray] = []
        while ranks:
            rank = heapq.heappop(ranks)
            some = index.pop(rank)
            pos = some[0] if len(some) == 1 else np.concatenate(some)
            if len(pos) > 1:
                pos = np.unique(pos)
            right = nxt[pos]
            ok = self.rank_of(tok[pos], tok[right]) == rank
            pos, right = pos[ok], right[ok]
            if len(pos) > 1 and (meets := right[:-1] == pos[1:]).any():  # as in aaa: every other one of a chain
                begin = np.concatenate([[True], ~meets])
                k = np.arange(len(pos))
                ok = (k - k[begin][np.cumsum(begin) - 1]) % 2 == 0
                pos, right = pos[ok], right[ok]
            if not len(pos):
                continue
            after = nxt[right]
            beside = self.rank_of(np.full(len(pos), rank), tok[after])
            tok[pos], tok[right] = rank, -2  # -2: merged away
            nxt[pos], prv[after] = after, pos
            before = prv[pos]
            follows = self.rank_of(np.full(len(pos), rank), tok[after])
            leads = np.where(before >= 0, self.rank_of(tok[before], np.full(len(pos), rank)), -1)
            low = ((beside >= 0) & (beside <= rank)) | ((follows >= 0) & (follows <= rank)) | ((leads >= 0) & (leads <= rank))
            if low.any():
                aside.append(pos[low])
            r, where = np.concatenate([follows, leads]), np.concatenate([pos, before])
            if (ok := r > rank).any():
                note(r[ok], where[ok])
        keep = tok >= 0
        ids = tok[keep].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(keep)])[starts] * 4
        out = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        if aside:
            redo = np.unique(np.searchsorted(starts, np.concatenate(aside), side="right") - 1).tolist()
            for k, x in zip(redo, self.replay_singly([pieces[k] for k in redo]), strict=True):
                out[k] = x
        return out

    def replay_singly(self, pieces: list[bytes]) -> list[bytes]:
        """As replay, one position at a time; a pair of lower rank goes first within its piece."""
        keys, values = array("q", self.pair_keys.tobytes()), self.pair_ranks
        last = len(keys) - 1

        def get(pair: int) -> int | None:
            at = min(bisect.bisect_left(keys, pair), last)
            return int(values[at]) if keys[at] == pair else None

        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)]).tolist()
        n = starts[-1]
        flat = np.full(n, -1, dtype=np.int64)  # no merge crosses the -1 after each piece
        gaps = np.array(starts[1:], dtype=np.int64) - 1
        flat[np.delete(np.arange(n), gaps)] = np.array(self.byte)[np.frombuffer(b"".join(pieces), np.uint8)]
        tok = flat.tolist()
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        if n > 1:
            data = np.zeros(n, np.uint8)
            data[flat >= 0] = np.frombuffer(b"".join(pieces), np.uint8)
            first = np.where((flat[:-1] >= 0) & (flat[1:] >= 0), self.of_bytes[data[:-1], data[1:]], -1)
            at = np.flatnonzero(first >= 0)
            at = at[np.argsort(first[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(first[at])) + 1
            for some in np.split(at, cuts) if len(at) else []:
                index[int(first[some[0]])] = some.tolist()
        ranks = list(index)
        heapq.heapify(ranks)
        while ranks:
            rank = heapq.heappop(ranks)
            positions = index.pop(rank, None)
            if positions is None:
                continue
            positions.sort()
            stop = -1  # positions below it wait for a pair of lower rank in the same piece
            for i in positions:
                if i < stop:
                    index[rank].append(i)
                    continue
                a = tok[i]
                if a < 0 or (b := tok[j := nxt[i]]) < 0 or get(a << 20 | b) != rank:
                    continue
                tok[i] = rank
                tok[j] = -2  # merged away
                after = nxt[i] = nxt[j]
                prv[after] = i
                if (t := tok[after]) >= 0 and (r := get(rank << 20 | t)) is not None:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(ranks, r)
                    index[r].append(i)
                    if r <= rank:
                        stop = starts[bisect.bisect_right(starts, i)]
                before = prv[i]
                if before >= 0 and (t := tok[before]) >= 0 and (r := get(t << 20 | rank)) is not None:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(ranks, r)
                    index[r].append(before)
                    if r <= rank:
                        stop = starts[bisect.bisect_right(starts, i)]
                if stop > i and rank not in index:
                    index[rank] = []
                    heapq.heappush(ranks, rank)
        flat = np.array(tok, dtype=np.int64)
        out = []
        for s, p in zip(starts, pieces, strict=False):
            part = flat[s : s + len(p)]
            out.append(part[part >= 0].astype("<u4").tobytes())
        return out

    def encode(self, texts: list[str | None], split) -> list[bytes]:
        """Ids of each text (little-endian 32-bit)."""
        if len(self.numbers) > CACHE_PIECES:
            self.numbers, self.encoded = Numbers(), []
        number = self.numbers.__getitem__
        pieces = [np.fromiter(map(number, split(t)), np.int32) if t else () for t in texts]
        new = list(islice(self.numbers, len(self.encoded), None))
        self.encoded += [b""] * len(new)
        slow = []
        for k, p in enumerate(new, len(self.encoded) - len(new)):
            i = self.ids.get(raw := p.encode())
            if i is None:
                slow.append((k, raw))
            else:
                self.encoded[k] = i.to_bytes(4, "little")
        for at in range(0, len(slow), REPLAY_PIECES):
            some = slow[at : at + REPLAY_PIECES]
            for (k, _), ids in zip(some, self.replay([raw for _, raw in some]), strict=True):
                self.encoded[k] = ids
        of = self.encoded.__getitem__
        return [b"".join(map(of, p.tolist())) if len(p) else b"" for p in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _ranks(path: str) -> Ranks:
    return Ranks(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _mapped(docs: DataFrame, text: str, keep: list[str], path: str | None, pattern: str | None, added: dict[str, pa.DataType], finish: Callable) -> DataFrame:
    """`keep` plus the columns that finish(ids of each text, ranks) makes, in one pass of Python."""
    path, pattern = path or default_path(), pattern or default_pattern()
    kinds = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    fields = [f.simpleString().replace(":", " ", 1) for f in docs.select(*keep).schema] + [f"{n} {kinds[t]}" for n, t in added.items()]
    util.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, split = _ranks(path), regex.compile(pattern).findall
        for whole in batches:
            for part in util.slices(whole, "__text", SLICE_BYTES):
                cols = finish(ranks.encode(part.column("__text").to_pylist(), split), ranks)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(c, t) for c, t in zip(cols, added.values(), strict=True))], [*keep, *added])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, ", ".join(fields))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: doc_id), plus n_tokens and ids (little-endian unsigned 32-bit), for every row."""
    added = {"n_tokens": pa.int64(), "ids": pa.binary()}
    return _mapped(docs, text, ["doc_id"] if keep is None else keep, path, pattern, added, lambda ids, _: ([len(x) // 4 for x in ids], ids))


def decode(tokens: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all columns) plus decoded (binary), from the column ids."""
    keep = tokens.columns if keep is None else keep
    path = path or default_path()
    fields = [f.simpleString().replace(":", " ", 1) for f in tokens.select(*keep).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path)
        for whole in batches:
            for part in util.slices(whole, "ids", 4 << 20):
                texts = [ranks.decode(x) if x else b"" for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.binary())], [*keep, "decoded"])

    return tokens.mapInArrow(run, ", ".join([*fields, "decoded binary"]))


def encode_and_check(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """`keep` plus n_tokens, ids, and decoded_sha256 of what those ids decode to."""
    added = {"n_tokens": pa.int64(), "ids": pa.binary(), "decoded_sha256": pa.string()}
    finish = lambda ids, ranks: ([len(x) // 4 for x in ids], ids, [hashlib.sha256(ranks.decode(x)).hexdigest() for x in ids])
    return _mapped(docs, "text", ["doc_id"] if keep is None else keep, path, pattern, added, finish)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """`keep` plus n_tokens, ids_sha256 and decoded_sha256: encode, then decode those ids."""
    added = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    digest = lambda x: hashlib.sha256(x).hexdigest()
    finish = lambda ids, ranks: ([len(x) // 4 for x in ids], map(digest, ids), [digest(ranks.decode(x)) for x in ids])
    return _mapped(docs, "text", ["doc_id"] if keep is None else keep, path, pattern, added, finish)
