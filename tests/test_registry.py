"""Every registered query with SQL gives what DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from strandlake.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{SF}/{name}')")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) or hasattr(v, "item"):
        return round(float(v), 7)
    return v


def rows(frame, columns):
    return sorted(repr(tuple(plain(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).fetchdf()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert len(ours)
    assert rows(ours, columns) == rows(theirs, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    found = entry.entry(spark)
    assert found.columns == ["sample", "factor", "unique_factor", "auc", "unique_auc"]
    assert found.count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_optional_queries(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "strandlake.llm", None)
    monkeypatch.setitem(sys.modules, "strandlake.llm.queries", None)
    assert set(entry.queries()) == set(QUERIES)


def test_core_imports_nothing_optional():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "strandlake"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "strandlake.llm" not in path.read_text(), path
