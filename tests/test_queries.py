"""Every query of the library against its SQL in DuckDB, as multisets of rounded rows."""

from collections import Counter

import duckdb
import pytest

from annolake.plans import evaluations, oracles, preparation  # noqa: F401
from annolake.plans import queries as own

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    flat = lambda v: round(v, 5) if isinstance(v, float) else v
    return Counter(tuple(flat(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(own.ORACLE))
def test_same_as_sql(spark, duck, name):
    df = own.QUERIES[name](spark, D)
    got = df.collect()
    done = duck.execute(own.ORACLE[name])
    names = [c[0] for c in done.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, done.fetchall())


@pytest.mark.parametrize("name", sorted(set(own.QUERIES) - set(own.ORACLE)))
def test_runs(spark, name):
    assert own.QUERIES[name](spark, D).count() > 0


def test_entry_imports_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__

    before = set(__spark_entry__.queries())
    monkeypatch.setitem(sys.modules, "annolake.llm", None)
    monkeypatch.setitem(sys.modules, "annolake.llm.entry", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        alone = importlib.reload(__spark_entry__)
        assert set(alone.queries()) == set(own.QUERIES) <= before
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
