"""Rules of job descriptions, and metrics that have no SQL."""

import numpy as np
import pytest

from strandlake.operators import metrics as mt
from strandlake.plans import spec


def test_keys(spark):
    df = spark.createDataFrame([("a", "10", 1), ("a", "9", 2), ("b", "1", 3)], "x string, y string, z int")
    order = lambda s: [r["z"] for r in df.orderBy(*spec.key_columns(s, df.columns)).collect()]
    assert order("-k1,1 -k2,2n") == [2, 1, 3] and order("-k1,2") == [1, 2, 3] and order("-k1,1r -k2,2nr") == [3, 1, 2]
    for bad in ("-k0,1", "-k2,1", "-k1,9", "-kx"):
        with pytest.raises(ValueError):
            spec.key_columns(bad, df.columns)


def test_counts_and_arguments():
    assert [spec.task_count(r, 8) for r in ("12", "3x", "5,40", "9,", "9,10")] == [12, 24, 8, 16, 10]
    assert [spec.reported_alignments(a) for a in ("", "-k 5", "-k5 -a", "-a -k 2", "--all", "-t 3")] == [1, 5, -1, 2, -1, 1]


def test_manifest_addresses(spark):
    df = spark.createDataFrame([("ftp://h/d/a.gz", "0", None)], "url1 string, md5_1 string, url2 string")
    assert tuple(spec.localized(df, "/data/").first()) == ("/data/a.gz", "0", None)
    assert spec.one_row_tasks(spark.range(7), 5).rdd.getNumPartitions() == 5


def test_regression(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=50), rng.normal(size=50)
    y = 3 * a + 0.1 * rng.normal(size=50)
    values = spark.createDataFrame([("g", i, float(v)) for i, v in enumerate(y)], "region string, sample int, value double")
    cov = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(zip(a, b))], "sample int, a double, b double")
    got = {r["term"]: r["share"] for r in mt.regression_shares(values, cov, ["region"], ["a", "b"]).collect()}
    assert got["a"] > 0.99 and got["b"] < 0.01 and abs(sum(got.values()) - 1) < 1e-9


def test_mates(spark):
    t = spark.createDataFrame([(1, [["x", "y"], ["z"]]), (2, [["q"], []])], "k int, i array<array<string>>")
    c = spark.createDataFrame([(1, [["z"], ["y", "w"]]), (3, [["r"], ["r"]])], "k int, i array<array<string>>")
    got = {r["k"]: (r["matched"], r["relevant"], r["retrieved"]) for r in mt.mate_matches(t, c, "k", "i").collect()}
    assert got == {1: (2, 3, 3), 2: (0, 1, 0), 3: (0, 0, 2)}
