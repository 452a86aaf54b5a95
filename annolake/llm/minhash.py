"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification, components.

A text's set holds the hashes of its distinct 5-word shingles. Two permutations of a universe of bins give all
signature coordinates: the first scatters a shingle to bin s, and coordinate k is the minimum over the set of the
second permutation at s + k, that is, of the second permutation circularly shifted by k. A slice of the second
permutation at s therefore holds all coordinates of one shingle.

Texts with equal sets form a class, and one document stands for it. Signatures are banded; every bucket of a band
links its documents to a few chosen centres (never all pairs), the links are verified on the full sets, and
components are labelled. In buckets that still span several components, members outside the largest one are then
compared with `FRESH` fresh documents of it, and buckets of at most `FEW` members compare all pairs across components.
Larger buckets that are still mixed after that are settled exactly: their documents meet by the rarest shingles of
their full sets (prefix filter with size and position bounds), and every pair of two components that can be similar
enough is verified. So every pair that shares a bucket is linked, compared, ruled out by a bound, or in one component.

Defined cases: texts without words have an empty set, no links, and form their own component; null text is empty;
rows of equal doc_id are one node; a null doc_id gets component_id null and kept true; very long texts are cut nowhere; other
columns are not read. Hot buckets cost one row per member: each side of a join is one row per bucket or splits freely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import util, words
from .components import components

BINS = 1 << 20
BANDS, ROWS = 32, 4
COORDS = BANDS * ROWS
CENTRES = 2
FEW = 16
FRESH = 3
BLOCK = 1000


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1723)
    scatter = rng.permutation(BINS).astype(np.int32)
    shifted = rng.permutation(BINS).astype(np.int32)
    wrapped = np.concatenate([shifted, shifted[:COORDS]])
    return scatter, np.lib.stride_tricks.sliding_window_view(wrapped, COORDS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set of 64-bit hashes."""
    scatter, slices = _permutations()
    at = scatter[(shingles >> np.uint64(40)).astype(np.int64) & (BINS - 1)]
    best = np.full(COORDS, BINS, np.int32)
    for k in range(0, len(at), 2048):
        np.minimum(best, slices[at[k : k + 2048]].min(axis=0), out=best)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        h = words.mix64(h ^ (rows[:, r] + np.uint64(r + 1)))
    return h.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part in util.slices(whole, "text", 2 << 20):
            sets = words.shingle_sets(*util.flat_bytes(part.column("text")))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            bands = [band_keys(signature(s)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs with 100 * intersection >= 75 * union."""
    held: tuple = (None, None)
    for whole in batches:
        for part in util.slices(whole, "text_a", 1 << 20):
            left = words.shingle_sets(*util.flat_bytes(part.column("text_a")))
            good = []
            for s, b, text in zip(left, part.column("b").to_pylist(), part.column("text_b"), strict=True):
                if held[0] != b or held[1] is not text and held[2] != text.as_py():
                    raw = text.as_py() or b""
                    held = (b, text, raw, words.shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
                t = held[3]
                both = np.intersect1d(s, t, assume_unique=True).size
                good.append(both > 0 and 100 * both >= 75 * (len(s) + len(t) - both))
            yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Texts travel, as they are smaller than their sets.

    Documents are shuffled to their ids once; a document of many pairs is one row on its side, so the join splits.
    """
    texts = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    full = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set; rows of one id may have several sets."""
    for whole in batches:
        for part in util.slices(whole, "text", 1 << 20):
            sets = words.shingle_sets(*util.flat_bytes(part.column("text")))
            n = np.array([len(s) for s in sets], np.int64)
            own = np.array([int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets], np.int64)
            cols = [np.repeat(np.asarray(part.column("doc_id")), n), np.repeat(own, n), np.repeat(n, n).astype(np.int32), np.concatenate(sets).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["rep", "own", "n", "shingle"])


def across(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of `nodes` (rep, component) in two components: all that can have 100 * intersection >= 75 * union.

    Shingles of a set are ordered from rare to frequent. The first one that two such sets of n and m shingles share is at
    places i and j with 7 * (1 + least(n - i, m - j)) >= 3 * (n + m), hence among the first n / 4 + 1 of either set
    and the first n / 7 + 1 of the smaller one. A shingle's members outside its largest component meet its members in
    blocks of about `BLOCK`, and what is known of a shingle is a table of one row each, so a frequent one is spread over tasks.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(nodes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = texts.dropDuplicates(["doc_id", "text"]).mapInArrow(_shingles, "rep long, own long, n int, shingle long")
    times = util.materialise(sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    one = Window.partitionBy("rep", "own")
    # shingles that occur once come first in every order, and only count
    place = F.col("n") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("times", "shingle"))
    rare = sets.join(times, "shingle").select("rep", "n", "shingle", place.alias("i")).where("4 * (i - 1) <= n")
    rare = util.materialise(rare.join(nodes, "rep").select("shingle", "rep", "component", "n", "i", F.expr("7 * (i - 1) <= n").alias("early")))
    parts = rare.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"), F.max("early").alias("early"))
    keys = parts.groupBy("shingle").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"), F.max("early").alias("any"), F.count(F.lit(1)).alias("parts")
    )
    rare = rare.join(util.materialise(keys.where("parts > 1 and any").drop("any", "parts")), "shingle")
    # one of a pair is early: early ones meet all (kind 0), the others meet the early ones (kind 1)
    left = rare.where("component <> main").select("shingle", F.expr("explode(sequence(0, blocks - 1))").alias("block"), F.expr("int(not early)").alias("kind"), "rep", "component", "n", "i")
    right = rare.select(
        "shingle", F.expr("int(pmod(xxhash64(rep), blocks))").alias("block"), F.expr("explode(if(early, array(0, 1), array(0)))").alias("kind"),
        F.col("rep").alias("rep_b"), F.col("component").alias("component_b"), F.col("n").alias("m"), F.col("i").alias("j"), "main",
    )
    can = "component <> component_b and (component_b = main or rep < rep_b) and 7 * (1 + least(n - i, m - j)) >= 3 * (n + m)"
    met = left.join(right, ["shingle", "block", "kind"]).where(can)
    return met.select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    util.small_batches(docs.sparkSession)
    signed = util.materialise(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, bands array<long>"))
    full = signed.where("set_key is not null and doc_id is not null")
    classes = full.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").cast("int").alias("n"), F.first("bands").alias("bands"))
    classes = util.materialise(classes)
    members = full.select("doc_id", "set_key").join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep")
    # rows of one id with different sets are one node
    same_id = members.groupBy(F.col("doc_id")).agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    rejoined = members.join(same_id.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a <> b")

    rows = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    turn = F.col("band") % CENTRES
    centres = rows.groupBy("bucket").agg(
        F.min_by(F.struct("rep", "n"), F.struct(F.xxhash64("rep", turn), "rep")).alias("centre"), F.count(F.lit(1)).alias("members")
    ).where("members > 1")
    alike = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * 75
    tried = (
        rows.join(centres.select("bucket", "centre"), "bucket")
        .where((F.col("rep") != F.col("centre.rep")) & alike(F.col("n"), F.col("centre.n")))
        .select(F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b"))
    )
    tried = util.materialise(tried.distinct())
    links = util.materialise(verified(tried, docs).unionByName(rejoined).distinct())
    label = components(links)

    # buckets that still span several components: small ones compare all members across components, all of them
    # compare the members outside the bucket's largest component with a few fresh documents of that component
    shared = util.materialise(rows.join(centres.select("bucket", "members"), "bucket").select("bucket", "rep", "n", "members"))

    def labelled() -> DataFrame:
        return shared.join(label, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n", "members", F.coalesce("component", "rep").alias("component"))

    at = labelled()
    parts = at.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("size"),
        F.array_distinct(F.array(*(F.min_by(F.struct("rep", "n"), F.struct(F.xxhash64("rep", "bucket", F.lit(t)), "rep")) for t in range(FRESH)))).alias("heads"),
    )
    mixed = parts.groupBy("bucket").agg(F.max_by(F.struct("component", "heads"), F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    at = at.join(mixed.where("parts > 1").select("bucket", "main"), "bucket")
    outside = at.where(F.col("component") != F.col("main.component")).select("rep", "n", F.explode("main.heads").alias("head"))
    pairs = outside.where(alike(F.col("n"), F.col("head.n"))).select(F.col("rep").alias("a"), F.col("head.rep").alias("b"))
    few = at.where(F.col("members") <= FEW).select("bucket", "rep", "n", "component")
    other = few.select("bucket", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"))
    both = few.join(other, "bucket").where((F.col("component") < F.col("other")) & alike(F.col("n"), F.col("m")))
    pairs = pairs.unionByName(both.select(F.col("rep").alias("a"), "b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = util.materialise(pairs.join(tried, ["a", "b"], "left_anti"))

    def merged(label: DataFrame, pairs: DataFrame) -> DataFrame:
        """Labels with the verified ones of `pairs` as further links: only components are linked anew, not their nodes."""
        if pairs.isEmpty():
            return label
        side = lambda x: label.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
        named = verified(pairs, docs).join(side("a"), "a", "left").join(side("b"), "b", "left")
        onto = components(named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
        moved = label.join(onto.select(F.col("node").alias("component"), F.col("component").alias("onto")), "component", "left")
        return util.materialise(moved.select("node", F.coalesce("onto", "component").alias("component")).unionByName(onto.join(label, "node", "left_anti")))

    label = merged(label, pairs)
    # larger buckets that are still mixed: every pair across components that can be a link
    at = labelled().where(F.col("members") > FEW)
    mixed = at.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = util.materialise(at.join(mixed.select("bucket"), "bucket", "left_semi").select("rep", "component").distinct())
    if not open_.isEmpty():
        tried = tried.unionByName(pairs)
        label = merged(label, util.materialise(across(open_, docs).join(tried, ["a", "b"], "left_anti")))

    # the smallest id of a component over its members, as a class is known by its smallest id
    named = classes.join(label, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all columns: that of the smallest id, and of rows with one id the one whose
    text has the least hash. Rows without an id are all kept."""
    found = near_duplicates(docs)
    left = docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    twice = util.materialise(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    if twice.isEmpty():
        return left
    first = F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64("text"), "text")).alias("r")
    one = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("r.*")
    return left.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))
