"""Queries give all rows of their SQL where a group is large, on tables made for it."""

import re

import duckdb

from strandlake.plans.queries import ORACLE_SQL, QUERIES
from tests.test_registry import rows


def same_as_sql(spark, folder, name, **tables):
    """Write each table from its SELECT, run the query and its SQL over them, and give the query's rows."""
    con = duckdb.connect()
    for table, text in tables.items():
        con.execute(f"copy ({text}) to '{folder}/{table}.parquet' (format parquet)")
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    ours, theirs = QUERIES[name](spark, str(folder)).toPandas(), con.execute(ORACLE_SQL[name]).fetchdf()
    assert rows(ours, sorted(ours.columns)) == rows(theirs, sorted(ours.columns))
    return ours


def test_cojunction_runs_keeps_every_run_of_a_read(spark, tmp_path):
    lines = "select 1 as l_orderkey, p as l_partkey, 0 as l_suppkey, 1 as l_linenumber, 'A' as l_returnflag from range(13) t(p)"
    assert len(same_as_sql(spark, tmp_path, "cojunction_runs", lineitem=lines)) > 300


def test_seed_join_sends_no_kmers_to_the_driver(spark, tmp_path):
    tables = {"orders": "select o_orderkey, o_orderkey % 7 as o_custkey from range(40) t(o_orderkey)", "part": "select p_partkey from range(300) t(p_partkey)"}
    same_as_sql(spark, tmp_path, "seed_join", **tables)
    assert "Broadcast" not in QUERIES["seed_join"](spark, str(tmp_path))._jdf.queryExecution().toString()


#: Introns next to each other over the ends of cells, then far from each other, in some samples only.
SPREAD = """
select l_partkey, l_suppkey, case when l_partkey % 5 = 0 then 'A' else 'N' end as l_returnflag from (
  select p as l_partkey, (p * 7 + q * 3) % 50 as l_suppkey from range(1600, 1680) t(p), range(4) u(q) union all
  select p, q * 5 + p % 3 from range(0, 12) t(p), range(3) u(q) union all
  select 3000 + p * 3300 + q, q * 11 % 50 from range(6) t(p), range(5) u(q))"""


def shuffles_runs(spark, folder, name):
    plan = QUERIES[name](spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    return re.search(r"hashpartitioning\([^)]*(starts|sizes)#", plan)


def test_bounded_paths_over_cells_and_gaps(spark, tmp_path):
    same_as_sql(spark, tmp_path, "bounded_paths", lineitem=SPREAD)


def test_bounded_paths_shuffles_no_paths(spark, tmp_path):
    close = "select p as l_partkey, (p * 7 + q * 3) % 50 as l_suppkey, 'A' as l_returnflag from range(1600, 1680) t(p), range(4) u(q)"
    same_as_sql(spark, tmp_path, "bounded_paths", lineitem=close)
    assert not shuffles_runs(spark, tmp_path, "bounded_paths")


def test_fragment_sequences_over_cells_and_gaps(spark, tmp_path):
    same_as_sql(spark, tmp_path, "fragment_sequences", lineitem=SPREAD, part="select p as p_partkey from range(0, 20000) t(p)")


def test_fragment_sequences_shuffles_no_fragments(spark, tmp_path):
    close = "select p as l_partkey, (p * 7 + q * 3) % 50 as l_suppkey, 'A' as l_returnflag from range(1600, 1680) t(p), range(4) u(q)"
    same_as_sql(spark, tmp_path, "fragment_sequences", lineitem=close, part="select p as p_partkey from range(0, 2100) t(p)")
    assert not shuffles_runs(spark, tmp_path, "fragment_sequences")
