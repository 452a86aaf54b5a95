import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from annolake.llm import decontam, util

ITEMS = "item_id long, text string, doc_id int"


def plain_scores(index, words):
    out = {}
    windows = max(1, -(-(len(words) - decontam.PASSAGE) // decontam.STEP) + 1) if words else 0
    for w in range(windows):
        terms = {index.terms[x] for x in words[w * decontam.STEP : w * decontam.STEP + decontam.PASSAGE] if x in index.terms}
        scores = Counter()
        for t in terms:
            for p, s in zip(*index.postings[t], strict=True):
                scores[p] += s
        out |= {(w * decontam.STEP, p): s for p, s in scores.items()}
    return out


def test_wand_retrieves_all_above_the_threshold(spark):
    index = next(decontam.build(util.table(spark, "/root/testdata/sf0.1", "benchmark")))
    texts = [decontam.split_words(r.text) for r in util.table(spark, "/root/testdata/sf0.01", "documents").limit(120).collect()]
    for limit in (0.2, 0.35, 0.6):
        got = {(d, at, p): s for d, at, p, s in index.retrieve(texts, limit)}
        every = {(d, at, p): s for d, w in enumerate(texts) for (at, p), s in plain_scores(index, w).items()}
        assert {k for k, s in every.items() if s >= limit + 1e-6} <= set(got)
        assert all(abs(every[k] - s) < 1e-9 and s >= limit for k, s in got.items())


def test_copied_items_are_found_and_others_are_not(spark):
    d = "/root/testdata/sf0.01"
    docs, items = util.table(spark, d, "documents"), util.table(spark, d, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()}
    bank = items.collect()
    exact = {(r.doc_id, i.item_id) for r in docs.collect() for i in bank if i.text in r.text}
    assert exact and exact <= got and len(got - exact) <= 0.05 * len(exact)
    clean = decontam.keep_clean(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len({i for i, _ in got})


def test_shards_give_the_same(spark, monkeypatch):
    d = "/root/testdata/sf0.01"
    docs, items = util.table(spark, d, "documents"), util.table(spark, d, "benchmark")
    one = sorted(map(tuple, decontam.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontam, "SHARD_WORDS", 400)
    many = sorted(map(tuple, decontam.find_leaks(docs, items).collect()))
    assert [r[:2] for r in one] == [r[:2] for r in many] and np.allclose([r[2:] for r in one], [r[2:] for r in many])


def test_two_texts_of_one_item_are_one_leak_at_any_size_of_shards(spark, monkeypatch):
    texts = [" ".join(f"{w}{k}" for k in range(40)) + "? the answer is " + " ".join(f"{w}{w}{k}" for k in range(12)) + "." for w in ("red", "blue", "green")]
    items = spark.createDataFrame([(7, texts[0], 0), (7, texts[1], 0), (8, texts[2], 0)], ITEMS)
    docs = spark.createDataFrame([(1, f"{texts[0]} and then {texts[1]}"), (2, texts[2])], "doc_id long, text string")
    for words in (200_000, 25):
        monkeypatch.setattr(decontam, "SHARD_WORDS", words)
        assert sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()) == [(1, 7), (2, 8)]


def test_question_and_answer_both_count(spark):
    question = "which of the many rivers in the north of the old country runs backwards every second spring?"
    answer = "the quiet river named after nobody at all, they say."
    items = spark.createDataFrame([(1, question + "\n" + answer, 0), (1, question + "\n" + answer, 0), (2, None, 1), (None, "x", 2), (3, "", 3), (4, "yes", 4)], ITEMS)
    filler = "some words that have nothing to do with it " * 30
    docs = spark.createDataFrame([(1, filler + question + " " + answer + filler), (2, filler + question + filler), (3, None), (4, ""), (None, question + " " + answer)], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.item_id) for r in decontam.find_leaks(docs, items).collect())
    assert got == [(-1, 1), (1, 1)]


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten. eleven twelve thirteen fourteen fifteen", 0)], ITEMS)
    assert {r.doc_id for r in decontam.find_leaks(odd_docs, items).collect()} == {1, 2, 3, 12, None}
    assert decontam.keep_clean(odd_docs, items).count() == odd_docs.count() - 6
    none = spark.createDataFrame([], ITEMS)
    assert decontam.find_leaks(odd_docs, none).count() == 0 and decontam.keep_clean(odd_docs, none).count() == odd_docs.count()
    assert decontam.find_leaks(no_docs, items).count() == 0


def test_leaks_against_all_scores_of_all_items(spark, sf):
    """The whole decision without an index: every passage against every part of every item, then the overlap of words."""
    docs = util.table(spark, sf, "documents").select("doc_id", "text")
    bench = util.table(spark, sf, "benchmark")
    some = [r.text for r in bench.collect() if r.text][:6]
    # near copies: a word dropped or replaced here and there
    near = [(-1 - k, "before it " + " ".join(w if i % (9 + k) else "other" for i, w in enumerate(t.split())) + " after it") for k, t in enumerate(some)]
    docs = docs.unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    items = [(r.item_id, *decontam.question_and_answer(r.text)) for r in bench.select("item_id", "text").distinct().collect() if decontam.split_words(r.text)]
    n, df = len(items), Counter()
    for _, q, a in items:
        df.update(set(q + a))
    lengths = bench.select("item_id", "text").distinct().agg(F.avg(F.size(F.split("text", r"\s+")))).first()[0]
    norm = max(1.0, min(lengths, decontam.PART))
    parts = []
    for k, (_, q, a) in enumerate(items):
        own = q + a
        for at in range(0, len(own), decontam.PART):
            part = own[at : at + decontam.PART]
            if at == 0 or len(part) >= decontam.SHINGLE:
                tf = Counter(part)
                size = decontam.K1 * (1 - decontam.B + decontam.B * len(part) / norm)
                weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (decontam.K1 + 1) / (f + size) for t, f in tf.items()}
                parts.append((k, weight, sum(weight.values())))
    want = set()
    for r in docs.collect():
        own = decontam.split_words(r.text)
        for at in range(0, max(1, len(own) - decontam.PASSAGE + decontam.STEP), decontam.STEP) if own else ():
            here = set(own[at : at + decontam.PASSAGE])
            for k, weight, whole in parts:
                if sum(w for t, w in weight.items() if t in here) / whole < decontam.THRESHOLD:
                    continue
                item_id, q, a = items[k]
                text, reach = q + a, len(q + a)
                around = own[max(0, at - reach) : at + decontam.PASSAGE + reach]
                size = min(decontam.SHINGLE, len(text))
                there = {tuple(around[i : i + size]) for i in range(len(around) - size + 1)}
                covered = [any(tuple(text[j : j + size]) in there for j in range(max(0, i - size + 1), min(i, len(text) - size) + 1)) for i in range(len(text))]
                shares = [sum(c) / len(c) for c in (covered[: len(q)], covered[len(q) :]) if c]
                if min(shares) >= decontam.COVER:
                    want.add((r.doc_id, item_id))
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == want and any(i < 0 for i, _ in want)
