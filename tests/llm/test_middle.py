import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolake.llm import middle, util

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def direct(doc_id, text):
    """By slices of the whole string."""
    text = text or ""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not text or any(c in text for c in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc_id, n, "psm", a, b - a, sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_same_as_slices(spark):
    docs = util.table(spark, "/root/testdata/sf0.01", "documents")
    got = sorted(tuple(r) for r in middle.digests(docs).collect())
    assert got == sorted(direct(r.doc_id, r.text) for r in docs.collect())


def test_odd_texts(spark, odd_docs, no_docs):
    rng = random.Random(1)
    texts = ["", "a", "é", "🙂", "<P>", "x<S", "<", "a<M>b", "\x00", "中" * 5000, "".join(rng.choice("aé中🙂<>PSM\n") for _ in range(30_000)), "ab" * 2_000_000]
    rows = [(i, t, None, None, None, 0.5, None, 1) for i, t in enumerate(texts * 4)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema)).withColumns({"n": F.lit("x"), "form": F.lit(2), "output": F.lit(None).cast("int")})
    got = middle.digests(docs)
    assert got.columns == COLUMNS
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((direct(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=key)
    assert middle.digests(no_docs).count() == 0


@pytest.mark.parametrize("unit", [r"\w+\s*", r"[^\n]*\n", r"\d", "x*"])
def test_units_of_a_pattern(spark, odd_docs, unit):
    """Cuts lie at ends of matches, every text comes back, and other columns stay."""
    import regex

    docs = odd_docs.withColumn("n", F.lit(7))
    made = middle.fill_in_middle(docs, unit=unit, plain_from=100)
    rows = made.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert made.columns == [c for c in docs.columns if c not in middle.ADDED] + list(middle.ADDED) and len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        assert r.back == text
        ends = {0, len(text)} | {m.end() for m in regex.finditer(unit, text) if m.group()}
        assert r.n == len(ends) - 1
        if r.form != "plain":
            assert r.prefix_chars in ends and r.prefix_chars + r.middle_chars in ends


def test_tree_finds_every_unit():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 7, 8, 9, 100):
        units, chars = rng.integers(0, 4, size), rng.integers(0, 9, size)
        tree = middle.Fenwick(units, chars)
        for unit in range(1, int(units.sum()) + 1):
            block = int(np.searchsorted(np.cumsum(units), unit))
            assert tree.before(unit) == (block, int(units[:block].sum()), int(chars[:block].sum()))


def test_cuts_do_not_depend_on_blocks():
    text = ("aé中🙂\n" * 300).encode()
    for pattern in (None, r".\n?"):
        ends = middle.unit_ends(text, pattern)
        want = None
        for block in (1, 2, 3, 64, 10_000):
            cutter = middle.Cutter(text, ends, block)
            got = [cutter.cut(k) for k in range(cutter.n + 1)]
            want = want or got
            assert got == want and got[-1] == (len(text), 1500)
