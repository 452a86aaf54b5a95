import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from annolake.llm import minhash, util, words
from annolake.llm.components import components


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected(rows):
    """doc_id to (set sizes, component, kept) by comparing all pairs that share a shingle."""
    sets, where = [(r.doc_id, shingle_set(r.text)) for r in rows], defaultdict(set)
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, s) in enumerate(sets):
        if i is not None:
            for g in s:
                where[g].add(k)
    for k, (i, s) in enumerate(sets):
        for j in {j for g in s for j in where.get(g, ()) if j < k} if i is not None else ():
            n = len(s & sets[j][1])
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((top(i), top(sets[j][0])))
                up[b] = a
    return sorted((i is None, i or 0, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_against_all_pairs(spark, sf):
    docs = util.table(spark, sf, "documents")
    assert got(minhash.near_duplicates(docs)) == expected(docs.collect())


def test_odd_rows(odd_docs, no_docs):
    key = lambda rows: sorted((str(x) for x in rows))
    assert key(got(minhash.near_duplicates(odd_docs))) == key(expected(odd_docs.collect()))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_a_crowded_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(300):
        own = list(base)
        own[int(rng.integers(0, 60))] = f"own{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"z{i}_{k}" for k in range(60))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(docs)) == expected(docs.collect())


def test_families_that_share_only_crowded_buckets(spark):
    """Pairs of 0.75 and more around one long template, chosen so that all buckets they share are full of others."""
    template = [f"t{k}" for k in range(160)]

    def keys(text):
        (s,) = words.shingle_sets(*util.flat_bytes(pa.array([text.encode()])))
        return s, set(minhash.band_keys(minhash.signature(s)).tolist())

    rows = [(i, " ".join([*template, *(f"m{k}" for k in range(30)), f"own{i}"])) for i in range(60)]
    rows += [(100 + i, " ".join([*template, *(f"s{i}_{k}" for k in range(33))])) for i in range(100)]
    times = Counter(k for _, text in rows for k in keys(text)[1])
    crowded = {k for k, n in times.items() if n > 2 * minhash.FEW}
    found = 0
    for i in range(3000):
        x, y = (" ".join([*template, *(f"b{i}_{k}" for k in range(7)), *(f"{side}{i}_{k}" for k in range(27))]) for side in "xy")
        (s, a), (t, b) = keys(x), keys(y)
        n = len(np.intersect1d(s, t))
        if 100 * n >= 75 * (len(s) + len(t) - n) and a & b and a & b <= crowded:
            rows += [(1000 + 2 * found, x), (1001 + 2 * found, y)]
            found += 1
            if found == 5:
                break
    assert found == 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(docs)) == expected(docs.collect())


def test_signature_is_the_minimum_of_shifts():
    s = np.random.default_rng(0).integers(0, 2**63, 50, dtype=np.uint64)
    scatter, slices = minhash._permutations()
    bins = scatter[(s >> np.uint64(40)).astype(np.int64) & (minhash.BINS - 1)]
    second = slices[:, 0]
    assert minhash.signature(s).tolist() == [int(second[(bins + k) % minhash.BINS].min()) for k in range(minhash.COORDS)]


def test_components_of_a_chain(spark):
    edges = spark.range(1, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(100, 101)], "a long, b long"))
    out = {r.node: r.component for r in components(edges).collect()}
    assert out == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_one_row_of_each_group_stays(spark, odd_docs):
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and sum(r.doc_id is None for r in rows) == 2
    assert set(ids) == {r.doc_id for r in minhash.near_duplicates(odd_docs).collect() if r.kept and r.doc_id is not None}
