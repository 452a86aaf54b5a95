"""Benchmark decontamination: BM25 over test items, searched by block-max WAND, then verified.

Test items are cut into parts of at most `PART` words and indexed: every term has its postings (part, impact), with the largest
impact of the list and of each block of parts. An impact is the term's BM25 weight in the part as a share of the part's whole
weight, so a passage's score against a part lies between 0 and 1 and one threshold serves all parts. Every
passage of every document (`PASSAGE` words, stepping `STEP`, so that a part copied anywhere lies within one) is a query. Sums
of list and block maxima rule out most passages at once; block-max WAND retrieves all parts above the threshold for the others.

A retrieved item counts as leaked if the document's words around the passage cover at least `COVER` of the words of its question
and of its answer by common five-word shingles (fewer words: the whole sequence). The answer is the item's last sentence,
the question what comes before; an item of one sentence is its own question.

Defined cases: null or wordless items and texts match nothing; repeated item rows count once; rows of the result are unique
for a document row and item; a null doc_id is reported as null; other columns are not read. The index is built and broadcast in shards of at most
about `SHARD_WORDS` words of items, whatever the size of the benchmark; document frequencies are counted over all items.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import util

PART, PASSAGE, STEP = 64, 128, 64
K1, B = 1.2, 0.75
THRESHOLD = 0.6
COVER = 0.75
SHINGLE = 5
SHARD_WORDS = 200_000
BLOCKS = 64
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def split_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer (empty for an item of one sentence)."""
    sentences = [w for w in map(split_words, _SENTENCE.split(text)) if w]
    if len(sentences) < 2:
        return (sentences[0] if sentences else []), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


class Index:
    """Postings with list and block maxima for one shard of items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float):
        self.items = []
        parts: list[tuple[int, list[str]]] = []
        for item_id, text in items:
            question, answer = question_and_answer(text)
            all_words = question + answer
            if not all_words:
                continue
            self.items.append((item_id, question, answer))
            for at in range(0, len(all_words), PART):
                part = all_words[at : at + PART]
                if at == 0 or len(part) >= SHINGLE:
                    parts.append((len(self.items) - 1, part))
        self.item_of = [i for i, _ in parts]
        self.block = max(1, -(-len(parts) // BLOCKS))
        self.terms: dict[str, int] = {}
        self.postings: list[tuple[list[int], list[float]]] = []
        norm_words = max(1.0, min(mean_words, PART))
        for p, (_, part) in enumerate(parts):
            tf = Counter(part)
            length = K1 * (1 - B + B * len(part) / norm_words)
            weight = {t: np.log(1 + (n_items - df.get(t, 1) + 0.5) / (df.get(t, 1) + 0.5)) * f * (K1 + 1) / (f + length) for t, f in tf.items()}
            whole = sum(weight.values())
            for t, w in weight.items():
                k = self.terms.setdefault(t, len(self.terms))
                if k == len(self.postings):
                    self.postings.append(([], []))
                self.postings[k][0].append(p)
                self.postings[k][1].append(float(w / whole))
        self.blocks = np.zeros((len(self.terms), BLOCKS), np.float32)
        for k, (ps, ws) in enumerate(self.postings):
            np.maximum.at(self.blocks[k], np.array(ps) // self.block, np.array(ws, np.float32))
        self.most = [max(ws) for _, ws in self.postings]

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (part, score) with score >= threshold, by block-max WAND."""
        out = []
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        block_max = self.blocks
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            b = part // self.block
            if sum(float(block_max[t, b]) for _, _, t in cursors[: pivot + 1]) < threshold - 1e-6:
                to = (b + 1) * self.block  # no part of this block can do it with these lists
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, part + 1)
                move = range(pivot + 1)
            elif cursors[0][0] == part:
                score = sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= threshold:
                    out.append((part, score))
                to, move = part + 1, range(pivot + 1)
            else:
                to, move = part, range(pivot)
            for k in move:
                c = cursors[k]
                ps = self.postings[c[2]][0]
                c[1] = bisect.bisect_left(ps, to, c[1])
                c[0] = ps[c[1]] if c[1] < len(ps) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def retrieve(self, texts: list[list[str]], threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the passage, part, score) of every hit in texts given as words."""
        if not self.terms:
            return
        get = self.terms.get
        ids, win, first, base = [], [], [], 0
        for d, own in enumerate(texts):
            code = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
            at = np.flatnonzero(code >= 0)
            windows = max(1, -(-(len(own) - PASSAGE) // STEP) + 1) if own else 0
            first += [(d, w * STEP) for w in range(windows)]
            # a word lies in the window that starts in its step, and in the one before
            own_win = at // STEP
            for shift in range(PASSAGE // STEP):
                ok = (own_win - shift >= 0) & (own_win - shift < windows)
                ids.append(code[at[ok]])
                win.append(own_win[ok] - shift + base)
            base += windows
        if not base:
            return
        key = np.unique(np.concatenate(win) * len(self.terms) + np.concatenate(ids))
        if not len(key):
            return
        win_of, term = key // len(self.terms), key % len(self.terms)
        start = np.flatnonzero(np.concatenate([[True], win_of[1:] != win_of[:-1]]))
        stop = np.append(start[1:], len(key))
        bounds = np.zeros(len(start), np.float32)
        for lo in range(0, len(start), 256):  # some windows at a time, for memory
            a, b = start[lo], stop[min(lo + 256, len(start)) - 1]
            bounds[lo : lo + 256] = np.add.reduceat(self.blocks[term[a:b]], start[lo : lo + 256] - a, axis=0).max(axis=1)
        for k in np.flatnonzero(bounds >= threshold - 1e-4).tolist():
            d, at = first[win_of[start[k]]]
            for part, score in self.wand(term[start[k] : stop[k]].tolist(), threshold):
                yield d, at, part, score

    def verify(self, item: int, around: list[str]) -> tuple[float, float]:
        """Shares of the question's and the answer's words that common shingles cover."""
        _, question, answer = self.items[item]
        own = question + answer
        k = min(SHINGLE, len(own))
        there = {tuple(around[i : i + k]) for i in range(len(around) - k + 1)}
        covered = np.zeros(len(own), bool)
        for i in range(len(own) - k + 1):
            if tuple(own[i : i + k]) in there:
                covered[i : i + k] = True
        q = float(covered[: len(question)].mean())
        return q, float(covered[len(question) :].mean()) if answer else q

    def leaks(self, texts: list[str | None], threshold: float = THRESHOLD) -> list[dict[int, tuple[float, float, float]]]:
        """For each text its leaked items: item id to (best score, question overlap, answer overlap)."""
        split = [split_words(t) for t in texts]
        found: list[dict] = [{} for _ in texts]
        spots: dict[tuple[int, int], list] = defaultdict(list)
        for d, at, part, score in self.retrieve(split, threshold):
            spots[d, self.item_of[part]].append((at, score))
        for (d, item), hits in spots.items():
            item_id, question, answer = self.items[item]
            reach = len(question) + len(answer)
            done = -1
            for at, score in hits:
                held = found[d].get(item_id)
                if held:
                    found[d][item_id] = (max(held[0], score), *held[1:])
                    continue
                lo, hi = max(0, at - reach), at + PASSAGE + reach
                if hi <= done:
                    continue
                q, a = self.verify(item, split[d][lo:hi])
                done = hi
                if q >= COVER and a >= COVER:
                    found[d][item_id] = (score, q, a)
        return found


def build(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark's shards, one after another."""
    util.small_batches(benchmark.sparkSession)
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    term = items.select("item_id", "text", F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")).alias("terms"))
    sizes = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("w")).first()
    if not sizes.n:
        return
    shards = max(1, -(-sizes.w // SHARD_WORDS))
    df = term.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for s in range(shards):
        own = term.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == s)  # all texts of an item are in one shard
        needed = own.select(F.explode("terms").alias("term")).distinct().join(df, "term")
        yield Index([(r.item_id, r.text) for r in own.select("item_id", "text").orderBy("item_id", "text").collect()], dict(needed.collect()), sizes.n, sizes.w / sizes.n)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every leaked item of every document."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in build(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for part in util.slices(whole, "text", 2 << 20):
                    found = shared.value.leaks(part.column("text").to_pylist())
                    rows = [(d, i, *x) for d, f in zip(part.column("doc_id").to_pylist(), found, strict=True) for i, x in f.items()]
                    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that leak no item."""
    at = docs.columns.index("text")
    for index in build(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for part in util.slices(whole, whole.schema.names[at], 2 << 20):
                    found = shared.value.leaks(part.column(at).to_pylist())
                    yield part.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
