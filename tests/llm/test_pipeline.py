import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from annolake.llm import bpe, decontam, minhash, pii, quality, util


def shingles(words):
    """Five words in a row, and every shorter row, as an answer may have fewer."""
    return {tuple(words[k : k + n]) for n in range(1, 6) for k in range(len(words) - n + 1)}


def share(part, own):
    n = min(5, len(part))
    want = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)} if part else set()
    return len(want & own) / len(want) if want else 1.0


def test_stages_against_their_operators(spark, sf):
    """Every stage's decisions, made row by row outside Spark from the stage's input."""
    docs = util.table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "bpe"]
    inputs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r.doc_id: r.asDict() for r in docs.collect()})
        docs = util.materialise(stage(spark, docs, sf))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    result = {r.doc_id: r for r in docs.collect()}
    # 1: the classifier's own scores
    first = util.table(spark, sf, "documents")
    model = quality.fit(first, util.table(spark, sf, "labels"), train=util.fold(F.col("doc_id"), 5) != 0)
    assert set(inputs[1]) == {r.doc_id for r in quality.score(first, model).collect() if r.predicted == 1}
    # 2: one of each group
    frame = spark.createDataFrame([(i, r["text"]) for i, r in inputs[1].items()], "doc_id long, text string")
    assert set(inputs[2]) == {r.doc_id for r in minhash.near_duplicates(frame).collect() if r.kept}
    # 3: no item of the benchmark is left whole
    items = [r.text for r in util.table(spark, sf, "benchmark").collect()]
    assert all(t not in r["text"] for r in inputs[3].values() for t in items)
    # and what has gone shares enough of some item's question and of its answer, looked up in the whole text
    gone, parts = set(inputs[2]) - set(inputs[3]), [decontam.question_and_answer(t) for t in items]
    leaks = {i for i, r in inputs[2].items() if (own := shingles(decontam.split_words(r["text"]))) and any(share(q, own) >= decontam.COVER and share(a, own) >= decontam.COVER for q, a in parts)}
    assert gone <= leaks and len(leaks) < len(inputs[2]) / 2
    # 4: no pattern entry is left, and texts without digits or at signs are as they were
    for i, r in inputs[4].items():
        assert not pii.base_spans(r["text"])
        if not any(c.isdigit() or c == "@" for c in inputs[3][i]["text"]) and r["text"] != inputs[3][i]["text"]:
            raise AssertionError(r["text"])
    # 5: what is decoded is the text
    assert set(result) == set(inputs[4])
    ranks = bpe.Ranks(bpe.default_path())
    for i, r in result.items():
        assert ranks.decode(bytes(r.ids)).decode() == inputs[4][i]["text"] and r.decoded_sha256 == hashlib.sha256(inputs[4][i]["text"].encode()).hexdigest()


def test_run_reaches_the_same(spark, sf):
    got = corpus_pipeline.run(spark, sf).collect()
    assert got and len({r.doc_id for r in got}) == len(got)


def test_odd_rows_pass_all_stages(spark, sf, odd_docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "rank"]
    for start in (odd_docs, no_docs):
        docs = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = util.materialise(stage(spark, docs, sf))
            assert k == 4 or docs.columns == columns
