import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annolake.llm import quality, util

LABELS = "doc_id long, quality int, toxic int"


def test_isotonic_is_monotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    knots, values = quality.isotonic(x, (x + rng.normal(size=300) > 0).astype(float))
    assert (np.diff(knots) >= 0).all() and (np.diff(values) >= 0).all() and 0 <= values[0] <= values[-1] <= 1


def test_partition_sums_give_the_ridge_solution(spark):
    docs = util.table(spark, "/root/testdata/sf0.01", "documents")
    labels = util.table(spark, "/root/testdata/sf0.01", "labels")
    a = quality.fit(docs.repartition(7), labels, features=32)
    b = quality.fit(docs.coalesce(1), labels, features=32)
    assert np.allclose(a.beta, b.beta, atol=1e-6)


def test_held_out_rows_are_told_apart(spark):
    d = "/root/testdata/sf0.01"
    labels = util.table(spark, d, "labels")
    got = quality.quality_scores(util.table(spark, d, "documents"), labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.95  # area under the curve
    assert (held.predicted == (held.score >= 0.3)).all() and (held.predicted == held.quality).mean() > 0.95


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, None), (9, 0, 0), (99, 1, 0), (None, 1, 0), (3, None, 0)], LABELS)
    got = quality.quality_scores(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert quality.quality_scores(no_docs, labels).count() == 0
    no_labels = quality.quality_scores(odd_docs, spark.createDataFrame([], LABELS)).collect()
    assert all(r.score == 0.5 for r in no_labels)
    kept = quality.keep_good(odd_docs, quality.fit(odd_docs, labels))
    assert kept.columns == odd_docs.columns


def test_scores_do_not_see_other_columns(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = util.table(spark, d, "documents"), util.table(spark, d, "labels")
    model = quality.fit(docs, labels, train=util.fold(F.col("doc_id"), 5) != 0)
    a = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    b = {r.doc_id: r.score for r in quality.score(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model).collect()}
    assert a == pytest.approx(b)


def test_scores_against_a_direct_fit(spark, sf):
    """The same model by least squares over all rows at once, and isotonic steps by their min-max formula."""
    docs, labels = util.table(spark, sf, "documents"), util.table(spark, sf, "labels")
    model = quality.fit(docs, labels, train=util.fold(F.col("doc_id"), quality.FOLDS) != 0)
    rows = docs.join(labels.where("quality is not null"), "doc_id").select("doc_id", "text", "quality", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)).alias("q")).collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    stats = quality.document_stats(pa.array([(r.text or "").encode() for r in rows]))
    y, fitted = np.array([float(r.quality) for r in rows]), np.array([r.q != 0 for r in rows])
    rng = np.random.default_rng(7)
    w, b = rng.normal(0, 1, (quality.STATS, 384)) * (1.2 / np.sqrt(quality.STATS)), rng.uniform(0, 2 * np.pi, 384)
    mean, scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)

    def features(s):
        x = np.clip((s - mean) / scale, -6, 6)
        return np.hstack([np.cos(x @ w + b) * np.sqrt(2 / 384), x, np.ones((len(x), 1))])

    z = features(stats[fitted])
    penalty = np.sqrt(1e-3 * max(1.0, fitted.sum()) * 1e-2)
    beta = np.linalg.lstsq(np.vstack([z, penalty * np.eye(z.shape[1])]), np.concatenate([y[fitted], np.zeros(z.shape[1])]), rcond=None)[0]
    raw, own = features(stats[~fitted]) @ beta, y[~fitted]
    order = np.lexsort((own, raw))
    raw, own = raw[order], own[order]
    sums = np.concatenate([[0], np.cumsum(own)])
    level = [max(min((sums[k + 1] - sums[j]) / (k + 1 - j) for k in range(i, len(own))) for j in range(i + 1)) for i in range(len(own))]
    knots, values, i = [], [], 0
    while i < len(own):
        k = i
        while k + 1 < len(own) and abs(level[k + 1] - level[i]) < 1e-12:
            k += 1
        knots.append(raw[i : k + 1].mean())
        values.append((own[i : k + 1].sum() + 0.05) / (k + 1 - i + 0.1))
        i = k + 1
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    all_rows = docs.select("doc_id", "text").collect()
    raw = features(quality.document_stats(pa.array([(r.text or "").encode() for r in all_rows]))) @ beta
    want = np.clip(0.99 * np.interp(raw, knots, values) + 0.01 / (1 + np.exp(-np.clip(8 * (raw - 0.5), -30, 30))), 0, 1)
    assert [got[r.doc_id] for r in all_rows] == pytest.approx(want.tolist(), abs=1e-6)
