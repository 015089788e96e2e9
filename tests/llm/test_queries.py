"""The registered queries on the smallest tables, and the pipeline against its stages' brute-force rules."""

import os

import duckdb
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_sql(spark):
    from strandlake.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    for name, sql in ORACLE_SQL.items():
        ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(sql).fetchdf()
        key = sorted(ours.columns)
        assert key == sorted(theirs.columns)
        value = lambda v: None if pd.isna(v) else v if isinstance(v, str) else int(v)
        plain = lambda f: sorted(repr(tuple(map(value, r))) for r in f[key].astype(object).itertuples(index=False, name=None))
        assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name, columns", [
    ("op3_langid", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op7_toxicity", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op8_licenses", {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double", "expressions": "string"}),
    ("op4_fingerprints", {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}),
])
def test_columns_and_rows(spark, name, columns):
    from strandlake.llm.queries import QUERIES

    found = QUERIES[name](spark, SF)
    assert dict(found.dtypes) == columns
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline(spark):
    import corpus_pipeline as cp
    from strandlake.llm.ngram_join import jaccard_components
    from strandlake.llm.secret_scan import report

    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.4 * n < docs.count() <= n
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    components = jaccard_components(docs).collect()
    assert len({r["component_id"] for r in components}) > 0.97 * len(components)  # secrets may have told copies apart
    assert report(docs).agg({"n_hex": "sum", "n_access": "sum"}).first()[0] == 0
    assert cp.run(spark, SF).agg({"length": "max"}).first()[0] <= 4096


def test_stages_on_odd_rows(spark, tmp_path):
    """Each stage on nulls, empty and repeated rows, equal ids with unlike texts, columns of any names; and on no rows."""
    import random

    import corpus_pipeline as cp
    from tests.llm.conftest import prose

    rng = random.Random(3)
    clean, copied = [prose(rng, 60) for _ in range(6)], prose(rng, 60)
    item = " ".join(f"b{i}" for i in range(30))
    rows = [(1, clean[0]), (1, clean[1]), (2, copied), (3, copied + " x"), (None, copied), (None, clean[2]), (4, None), (4, None), (5, ""), (6, clean[3] + " " + item), (6, clean[4]), (7, "token = 24be64439e3e49cf46b2d7c90f3602a3")]
    names = "doc_id long, text string, lang string, source string, n_chars long, base int, _found int, score int, cls int, spans int"
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, 2, 3, 4, 5) for d, t in rows], names).repartition(2)
    folder = str(tmp_path)
    spark.createDataFrame([(900 + i, i % 2) for i in range(4)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages = dict(cp.STAGES)
    texts = lambda f: sorted(((r["doc_id"], r["text"]) for r in f.collect()), key=repr)
    want = {
        "toxicity": rows,  # no labelled row is in the table
        "ngram_jaccard": [r for r in rows if r not in ((3, copied + " x"), (None, copied))],
        "decontamination": [r for r in rows if item not in (r[1] or "")],
        "secrets": [*rows[:-1], (7, "[SECRET]")],
    }
    for name, kept in want.items():
        found = stages[name](spark, frame, folder)
        assert found.columns == frame.columns and texts(found) == sorted(kept, key=repr), name
        assert stages[name](spark, frame.limit(0), folder).count() == 0
    packed = stages["packing"](spark, frame, folder).collect()
    assert sum(r["start"] == 0 for r in packed) == len(rows) and stages["packing"](spark, frame.limit(0), folder).count() == 0


def test_stages_called_by_themselves_bound_batches(spark):
    import corpus_pipeline as cp

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs, before = spark.read.parquet(f"{SF}/documents.parquet").limit(20), spark.conf.get(name)
    try:
        for _, stage in cp.STAGES:
            spark.conf.set(name, str(64 << 20))
            stage(spark, docs, SF)
            assert spark.conf.get(name) == str(4 << 20)
    finally:
        spark.conf.set(name, before)
