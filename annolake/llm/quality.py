"""Document quality: random Fourier features, ridge normal equations, isotonic calibration.

Each document becomes a short vector of text statistics (character classes, word shapes, repetition,
compressibility). Random cosine features approximate a Gaussian kernel over the standardised vectors; every
partition of the labelled sample sums its own Z'Z and Z'y, and the sums give the ridge weights. A pool-adjacent-
violators fit on a part of the sample that the ridge fit has not seen turns raw scores into probabilities.

Defined cases: a null or empty text has all-zero statistics and is scored like any other; a null doc_id is
never held out and never trains; label rows that are null, or whose document is missing, are ignored; repeated
label rows count once each; without any usable label every score is 0.5. Labels, lang, source and doc_id are
not inputs of a score. Other columns are neither read nor returned.

`max_train` bounds the labels that a fit uses (chosen by a hash of the id), so the sample's ids can be broadcast, and then
the rows that carry them, so the fitted model does not grow with the corpus. Everything else covers all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import util

FOLDS = 5
THRESHOLD = 0.3
STATS = 22


def _class_table() -> np.ndarray:
    """Character classes by byte: one row per class."""
    b = np.arange(256)
    rows = [
        (b >= 97) & (b <= 122),
        (b >= 65) & (b <= 90),
        (b >= 48) & (b <= 57),
        (b == 32) | (b == 9),
        b == 10,
        np.isin(b, list(b".,;:?")),
        b == 33,
        b == 124,
        np.isin(b, list(b"#$%&*@^~_=+<>\\{}[]")),
        np.isin(b, list(b"\"'()-/`")),
        b >= 192,
    ]
    return np.array(rows, dtype=np.uint8)


_CLASSES = _class_table()


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)


def document_stats(texts: pa.Array) -> np.ndarray:
    """Statistics of each text (UTF-8 binary): n x STATS."""
    data, offsets = util.flat_bytes(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets).astype(np.float64)
    safe = np.maximum(sizes, 1)
    out = np.zeros((n, STATS))
    for k, row in enumerate(_CLASSES):
        out[:, k] = _per_row(row[data], offsets) / safe
    k = len(_CLASSES)
    out[:, k] = np.log1p(sizes)
    for i, raw in enumerate(texts.to_pylist()):
        if not raw:
            continue
        words = raw.split()
        m = max(1, len(words))
        out[i, k + 1] = len(zlib.compress(raw, 1)) / (len(raw) + 12)
        out[i, k + 2] = len(set(words)) / m
        out[i, k + 3] = sum(map(bytes.__eq__, words, words[1:])) / m
        out[i, k + 4] = len(raw) / m
        out[i, k + 5] = np.log1p(m)
        lines = raw.split(b"\n")
        out[i, k + 6] = 1 - len(set(lines)) / len(lines)
        out[i, k + 7] = np.log1p(max(map(len, words), default=0))
        out[i, k + 8] = len(set(raw)) / min(256, len(raw))
        out[i, k + 9] = sum(map(bytes.isupper, words)) / m
        out[i, k + 10] = sum(map(bytes.isalpha, words)) / m
    return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres on the raw scale, and block means (never decreasing)."""
    order = np.lexsort((y, raw))
    blocks: list[list[float]] = []
    for x, v in zip(raw[order], y[order], strict=True):
        blocks.append([v, 1.0, x])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            v2, w2, x2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + v2, blocks[-1][1] + w2, blocks[-1][2] + x2]
    # one pseudo-observation of each label keeps a block of few rows away from 0 and 1
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.05) / (b[1] + 0.1) for b in blocks])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2.0 / len(self.b))
        return np.hstack([z, x, np.ones((len(x), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        raw = self.features(stats) @ self.beta
        level = np.interp(raw, self.knots, self.values)
        # a hundredth of the raw order keeps ties of the step function apart
        return np.clip(0.99 * level + 0.01 / (1 + np.exp(-np.clip(8 * (raw - 0.5), -30, 30))), 0, 1)


def _stats_rows(extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in util.slices(whole, "text", 2 << 20):
                stats = document_stats(part.column("text"))
                cols = [part.column(c) for c in extra]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(list(stats), pa.list_(pa.float64()))], [*extra, "stats"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, features: int = 384, seed: int = 7, ridge: float = 1e-3, train=None) -> QualityModel:
    """Fit on labelled rows of `docs` for which `train` (a Column over doc_id; default: all) holds."""
    util.small_batches(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if train is not None:
        usable = usable.where(train)
    keyed = usable.select("doc_id", F.col("quality").cast("double").alias("y"), F.xxhash64("doc_id", F.lit(seed)).alias("h"))
    sample = util.hash_sample(keyed, max_train, "doc_id", "y")
    read = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    read = read.select("y", "h", "text")
    stats = util.materialise(read.mapInArrow(_stats_rows(["y", "h"]), "y double, h long, stats array<double>"))
    if stats.count() > max_train:  # rows that repeat a labelled id
        stats = util.materialise(util.hash_sample(stats, max_train, "y", "stats"))
    rng = np.random.default_rng(seed)
    # bounded: two moments of each statistic
    moments = stats.select("y", F.posexplode("stats").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("k").collect()
    w, b = rng.normal(0, 1, (STATS, features)) * (0.6 / np.sqrt(STATS) * 2), rng.uniform(0, 2 * np.pi, features)
    empty = QualityModel(np.zeros(STATS), np.ones(STATS), w, b, np.zeros(features + STATS + 1), np.zeros(0), np.zeros(0))
    if not moments:
        return empty
    mean = np.array([r.m for r in moments])
    scale = np.array([max(r.s, 1e-6) for r in moments])
    model = QualityModel(mean, scale, w, b, empty.beta, empty.knots, empty.values)
    width = features + STATS + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for part in batches:
            if part.num_rows:
                z = model.features(np.array(part.column("stats").to_pylist()))
                total += z.T @ np.column_stack([z, np.asarray(part.column("y"))])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    # a fixed number of partitions, as the sample is bounded: what reaches the driver does not grow
    fitted = F.pmod(F.col("h"), F.lit(4)) != 0
    parts = stats.where(fitted).coalesce(8).mapInArrow(sums, "sums binary").collect()
    total = sum((np.frombuffer(r.sums).reshape(width, width + 1) for r in parts), np.zeros((width, width + 1)))
    gram = total[:, :width] + ridge * max(1.0, total[-1, -2]) * np.eye(width) * 1e-2
    model.beta = np.linalg.solve(gram, total[:, -1])
    held = stats.where(~fitted).select("y", "stats").toArrow()  # a quarter of the bounded sample
    if held.num_rows == 0:
        held = stats.select("y", "stats").toArrow()
    raw = model.features(np.array(held.column("stats").to_pylist())) @ model.beta
    model.knots, model.values = isotonic(raw, np.asarray(held.column("y")))
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in util.slices(whole, "text", 2 << 20):
                s = model.score(document_stats(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    held = F.coalesce(util.fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores at least `threshold`."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in util.slices(whole, whole.schema.names[at], 2 << 20):
                s = model.score(document_stats(part.column(at).cast(pa.binary())))
                yield part.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled rows outside fold 0 and score every row."""
    model = fit(docs, labels, train=util.fold(F.col("doc_id"), FOLDS) != 0, **options)
    return score(docs, model)
