"""Repeated passages of words: confirmed by counting, compiled into automata, and located in every document.

1. Confirm. Windows of `SIZE` words whose anchor occurs more than once (see anchors.py) are counted over the corpus by 128-bit
   keys. Of all chunks that hold a window that occurs more than once, one is the window's own.
2. Compile. A chunk sends the dictionary the words of its own windows, each text once: windows in a row that share an anchor are one passage,
   of at most 2 * SIZE words, which goes to its anchor's shard; at an anchor that occurs more than `HOT` times every window
   is a passage, which goes to its own key's shard. A shard gives each chunk the passages of the anchors (or keys) that the chunk
   has. Their phrases of `GRAM` words (the anchor; of a single window its first words) are compiled into Aho-Corasick automata, one for
   about `SHARD` words.
3. Stream. Every document of the chunk runs through every automaton that it was given, all on one line of words. Around a hit the passage and the document
   are compared by their bytes; SIZE or more equal words in a row are windows of the passage, so all of them go. Positions come from hits alone: without the
   dictionary nothing is found.

A passage that a third of the documents share is sent to the dictionary once, and comes back once a chunk. Passages at one anchor are at most `HOT`.

Defined cases: null text has no words; texts of fewer than SIZE words keep every word; of several rows with the same id
and text every window occurs more than once; matches never cross rows; very long texts are cut nowhere; other columns are not
read. Windows are judged on the input, and a repeat within one text counts.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import anchors as an
from . import util, words

SIZE = 35
GRAM = 12
SHARD = 1_000_000
HOT = 8_192
ANCHORS, WINDOWS, NEEDS, PASSAGES = 0, 1, 2, 3
_STEPS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Windows:
    """The word windows of a chunk: their hashes, and the anchors that they stand at."""

    def __init__(self, chunk: an.Chunk):
        self.line = words.Line(chunk.raw)
        none = np.zeros(0, np.int64)
        self.anchor, self.at, self.first, self.last, self.row = none.astype(np.uint64), none, none, none, none
        hashes, first = self.line.hashes, self.line.first
        if len(hashes) < SIZE:
            return
        h = words.gram_hashes(hashes, GRAM)
        ok = np.zeros(len(hashes) - SIZE + 2, np.int32)
        long = np.diff(first) >= SIZE
        np.add.at(ok, first[:-1][long], 1)
        np.add.at(ok, first[1:][long] - SIZE + 1, -1)
        self.at, self.first, self.last = an.anchor_runs(h, np.cumsum(ok[:-1]) > 0, SIZE - GRAM + 1)
        self.anchor = h[self.at]
        self.row = np.searchsorted(first, self.at, side="right") - 1

    def anchors(self, chunk: an.Chunk) -> an.Keys:
        """Distinct anchors; in a row that stands for several equal ones, each occurs as often."""
        return an.Keys([self.anchor], chunk.copies[self.row])

    def keys(self, chunk: an.Chunk, run: np.ndarray) -> tuple[np.ndarray, an.Keys]:
        """Starts of the windows of the chosen runs, and their keys: two hashes of all words of a window."""
        first, size = self.first[run], (self.last - self.first + 1)[run]
        start = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        columns = [words.window_hashes(self.line.hashes, SIZE, k + 1, step, start) for k, step in enumerate(_STEPS)]
        return start, an.Keys(columns, np.repeat(chunk.copies[self.row[run]], size))


class Automaton:
    """Aho-Corasick over passages of words; a word is a pair of characters, of two alphabets, and words of no passage are one more pair. So a
    node has few branches, also the first, where thousands of words begin passages. Words are told by their 64-bit hashes: no occurrence is
    missed, and whoever takes one compares the words."""

    def __init__(self, passages: list[bytes]):
        line = words.Line(passages)
        #: the hashes of the passages' words, in order; the number of a word is the place of its hash
        self.known, number = np.unique(line.hashes, return_inverse=True)
        k = np.arange(len(self.known))
        #: two characters (UTF-16) for each number, and for all words without one
        self.pairs = np.append(0x400 + k // 512 | 0x200 + k % 512 << 16, 0x10001).astype("<u4")
        text = self.pairs[number.reshape(-1)].tobytes().decode("utf-16-le")
        same: dict[str, list[tuple[int, bytes]]] = {}
        for own, x, y in zip(passages, line.first.tolist(), line.first[1:].tolist(), strict=False):
            same.setdefault(text[2 * x : 2 * y], []).append((y - x, own))
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for key, owns in same.items():
            self.machine.add_word(key, owns)
        self.machine.make_automaton()

    def places(self, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Where a passage begins in a row of words, given by their hashes, and the passage, for every occurrence in the order of their ends."""
        text = self.pairs[words.places_of(hashes, self.known)].tobytes().decode("utf-16-le")
        for end, same in self.machine.iter(text):
            for n, passage in same:
                yield (end + 1) // 2 - n, passage

    def hits(self, own: list[bytes]) -> list[tuple[int, int]]:
        """(from, to) of every occurrence of a passage in a document."""
        found = ((at, at + passage.count(b" ") + 1, passage) for at, passage in self.places(words.Line([b" ".join(own)]).hashes))
        return [(x, y) for x, y, passage in found if b" ".join(own[x:y]) == passage]


def compiled(passages: Iterable[bytes | list[bytes]]) -> Iterator[Automaton]:
    """Automata of the distinct passages (words, or words joined by one space), each of about `SHARD` words."""
    distinct = list(dict.fromkeys(p if isinstance(p, bytes) else b" ".join(p) for p in passages))
    at = 0
    while at < len(distinct):
        stop, n = at, 0
        while stop < len(distinct) and (stop == at or n + distinct[stop].count(b" ") < SHARD):
            n += distinct[stop].count(b" ") + 1
            stop += 1
        yield Automaton(distinct[at:stop])
        at = stop


def _sent(chunk: an.Chunk, windows: Windows, answers: pa.Table, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(kind, bucket, payload): keys of the passages that a chunk needs, and those that it adds to the dictionary, each after the place of its phrase."""
    known = windows.anchors(chunk)
    run = np.flatnonzero(known.answered(answers, buckets, ANCHORS))
    hot = known.answered(answers, buckets, ANCHORS, 1)
    starts, keys = windows.keys(chunk, run)
    more = keys.answered(answers, buckets, WINDOWS)
    at = np.repeat(run, (windows.last - windows.first + 1)[run])
    key = np.where(hot[at], keys.columns[0][keys.of], windows.anchor[at])
    needed = np.unique(key[more])
    for b, where in an.dealt(an.bucket_of(needed, buckets)):
        yield NEEDS, b, an.pack(needed[where])
    # windows in a row, of one key, become one passage
    mine = np.flatnonzero(more & keys.answered(answers, buckets, WINDOWS, 2))
    if not len(mine):
        return
    starts, key, at = starts[mine], key[mine], at[mine]
    first = np.flatnonzero(np.concatenate([[True], (starts[1:] != starts[:-1] + 1) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])]))
    last = an.stops(first, len(starts)) - 1
    offset = np.where(hot[at[first]], 0, windows.at[at[first]] - starts[first])
    texts: dict[int, set[bytes]] = {}
    text, at = windows.line.text, windows.line.at
    for k, a, z, off in zip(key[first].tolist(), starts[first].tolist(), starts[last].tolist(), offset.tolist(), strict=True):
        texts.setdefault(k, set()).add(b"%d %s" % (off, text[at[a] : at[z + SIZE] - 1]))
    own = np.array(sorted(texts), np.uint64)
    for b, where in an.dealt(an.bucket_of(own, buckets)):
        some = [(int(k), t) for k in own[where] for t in sorted(texts[int(k)])]
        yield PASSAGES, b, an.pack(np.array([k for k, _ in some], np.uint64), zlib.compress(b"\n".join(t for _, t in some), 1))


def _given(rows: pa.Table) -> pa.Table:
    """For each chunk that needs passages of a shard: those that it needs."""
    kinds, payloads = rows.column("kind").to_pylist(), rows.column("payload")
    keys, texts = [], []
    for k, x in zip(kinds, payloads, strict=True):
        if k == PASSAGES:
            own, packed = an.unpack(x.as_py(), "<u8", None)
            keys.append(own)
            texts += zlib.decompress(packed).split(b"\n")
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    chunks, out = [], []
    for k, c, x in zip(kinds, rows.column("chunk").to_pylist(), payloads, strict=True):
        if k == NEEDS:
            (need,) = an.unpack(x.as_py(), "<u8")
            lo, hi = np.searchsorted(key, need), np.searchsorted(key, need, side="right")
            found = [texts[int(i)] for a, b in zip(lo.tolist(), hi.tolist(), strict=True) for i in order[a:b]]
            if found:
                chunks.append(c)
                out.append(zlib.compress(b"\n".join(found), 1))
    util.tidy()
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "payload": pa.array(out, pa.binary())})


class Passage:
    """A passage of the dictionary, with a space after each word: `size` words, of which `before` stand before its phrase."""

    __slots__ = ("before", "core", "line", "size", "start", "text")

    def __init__(self, line: words.Line, start: int, size: int, before: int):
        self.line, self.start, self.size, self.before = line, start, size, before
        #: words [size - SIZE, SIZE), which every window of a passage holds, and which hold the phrase
        self.core = line.spaced(start + size - SIZE, start + SIZE)
        self.text = line.spaced(start, start + size)

    def part(self, own: words.Line, row: tuple[int, int], lo: int) -> tuple[int, int]:
        """(from, to) of the words that a document and the passage share around its core, which the document has. The document's words are those of
        `row` on the line `own`; the passage would begin at word lo of that line."""
        x, y, move = lo + self.size - SIZE, lo + SIZE, self.start - lo
        left, more = 0, min(self.size - SIZE, x - row[0])  # the most words that are equal to the left, and to the right, by halving
        while left < more:
            k = (left + more + 1) // 2
            left, more = (k, more) if own.holds(self.line.spaced(x - k + move, x + move), x - k) else (left, k - 1)
        right, more = 0, min(self.size - SIZE, row[1] - y)
        while right < more:
            k = (right + more + 1) // 2
            right, more = (k, more) if own.holds(self.line.spaced(y + move, y + k + move), y) else (right, k - 1)
        return x - left, y + right


def _by_phrase(given: list[bytes]) -> dict[bytes, tuple[int, int, Sequence[Passage]]]:
    """Passages, each after the place of its phrase: for each phrase its passages, long ones first, and the most words before it and from it on."""
    line = words.Line(given)
    first, by, several = line.first.tolist(), {}, {}
    for text, x, y in zip(given, first, first[1:], strict=False):
        before = int(text[: text.index(b" ")])
        phrase, passage = line.words(x + 1 + before, x + 1 + before + GRAM), Passage(line, x + 1, y - x - 1, before)
        if phrase in by:
            several.setdefault(phrase, [*by[phrase][2]]).append(passage)
        else:
            by[phrase] = before, passage.size - before, (passage,)
    for phrase, own in several.items():
        by[phrase] = max(p.before for p in own), max(p.size - p.before for p in own), sorted(own, key=lambda p: -p.size)
    return by


def _located(chunk: an.Chunk, given: list[bytes]) -> pa.Table:
    """Results for the distinct rows of a chunk, by the hits of the passages' phrases in them. All rows run through an automaton on one line; a hit
    that crosses rows is none."""
    line, by = words.Line(chunk.raw), _by_phrase(given)
    first, text, at = line.first.tolist(), line.text, line.at
    found: list[list[tuple[int, int]]] = [[] for _ in chunk.raw]
    for automaton in compiled(by):
        z = 0
        for x, phrase in automaton.places(line.hashes):
            if x >= z:  # the next row with hits
                r = bisect.bisect_right(first, x) - 1
                spans, a, z = found[r], first[r], first[r + 1]
                lo = hi = -1  # the span that grows as hits come
            before, after, passages = by[phrase]
            if x + GRAM > z or (lo <= x - before and x + after <= hi):
                continue
            for p in passages:
                start = x - p.before
                stop = start + p.size
                if lo <= start and stop <= hi:
                    continue
                if stop - SIZE < a or start + SIZE > z or not text.startswith(p.core, at[stop - SIZE]):
                    continue
                if start < a or stop > z or not text.startswith(p.text, at[start]):
                    start, stop = p.part(line, (a, z), start)
                    if stop - start < SIZE:
                        continue
                if lo <= start <= hi:
                    hi = max(hi, stop)
                    spans[-1] = lo, hi
                else:
                    lo, hi = start, stop
                    spans.append((lo, hi))
    out = []
    for a, z, hits in zip(first, first[1:], found, strict=False):
        spans = an.union(hits)
        edges = [a, *(k for span in spans for k in span), z]
        kept = b"".join([line.spaced(x, y) for x, y in zip(edges[::2], edges[1::2], strict=True)])
        n = sum(y - x for x, y in spans)
        out.append((z - a, n, hashlib.sha256(kept[:-1]).hexdigest(), [{"start": x - a, "stop": y - a} for x, y in spans]))
    cols = list(zip(*out, strict=True)) if out else [[]] * 4
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, list(_OUT)[1:], strict=True)], _OUT.names[1:])


def dictionary(table: DataFrame, buckets: int, hot: int = HOT) -> DataFrame:
    """What the chunks of a table (see anchors.keyed) need of the dictionary and add to it: rows of NEEDS and PASSAGES for its shards."""

    def ask_anchors(rows: pa.Table) -> pa.Table:
        chunk = an.Chunk(rows)
        return Windows(chunk).anchors(chunk).ask(rows.column("__chunk")[0].as_py(), buckets, ANCHORS)

    def ask_windows(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return an.ASKED_SCHEMA.empty_table()
        chunk = an.Chunk(rows)
        windows = Windows(chunk)
        run = np.flatnonzero(windows.anchors(chunk).answered(answers, buckets, ANCHORS))
        out = windows.keys(chunk, run)[1].ask(rows.column("__chunk")[0].as_py(), buckets, WINDOWS)
        util.tidy()
        return out

    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return an.ASKED_SCHEMA.empty_table()
        chunk = an.Chunk(rows)
        cols = list(zip(*_sent(chunk, Windows(chunk), answers, buckets), strict=True)) or [[]] * 3
        number = [rows.column("__chunk")[0].as_py()] * len(cols[0])
        util.tidy()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip((cols[0], cols[1], number, cols[2]), an.ASKED_SCHEMA, strict=True)], schema=an.ASKED_SCHEMA)

    mine = table.groupBy("__chunk")
    of_anchors = an.answered(mine.applyInArrow(ask_anchors, an.ASKED), hot)
    of_windows = an.answered(mine.cogroup(of_anchors.groupBy("chunk")).applyInArrow(ask_windows, an.ASKED), own=True)
    return mine.cogroup(of_anchors.unionByName(of_windows).groupBy("chunk")).applyInArrow(send, an.ASKED)


def located(table: DataFrame, sent: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans of every row of a table, by the passages that its chunks are given."""

    def locate(rows: pa.Table, given: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _OUT.empty_table()
        chunk = an.Chunk(rows)
        passages = {t for x in given.column("payload") for t in zlib.decompress(x.as_py()).split(b"\n")}
        result = _located(chunk, sorted(passages)).take(pa.array(chunk.of))
        util.tidy()
        return result.add_column(0, "doc_id", rows.column("doc_id").take(pa.array(chunk.order)))

    given = sent.groupBy("bucket").applyInArrow(_given, "chunk int, payload binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, stop: long>>"
    return table.groupBy("__chunk").cogroup(given.groupBy("chunk")).applyInArrow(locate, schema)


def removed_words(docs: DataFrame, chunk_bytes: int = an.CHUNK_BYTES, bucket_bytes: int = an.BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed spans (in words) of every row."""
    util.small_batches(docs.sparkSession)
    size = util.text_bytes(docs)
    table = an.keyed(docs, -(-size // chunk_bytes), ["doc_id"])
    return located(table, dictionary(table, -(-size // bucket_bytes), hot))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", an.SPANS)])
