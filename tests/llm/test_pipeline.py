import os
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from brute import base_spans, components, words
from marketlake.llm import oracle, queries
from marketlake.llm.scratch import documents


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    base = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = base.sql(oracle.oracle_sql()[name])
    got = queries.queries()[name](spark, sf_dir).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_stages(spark, sf_dir):
    docs, kept = documents(spark, sf_dir), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    raw = {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}
    assert len(kept[0]) >= 0.99 * len(raw)
    classes = components(list(kept[0].items()))
    assert set(kept[1]) == {c for _, n, c in classes if n} | {d for d, n, _ in classes if not n}
    found = {r["doc_id"] for r in queries.op8_decontamination(spark, sf_dir).collect() if r["contaminated"]}
    assert set(kept[2]) == set(kept[1]) - found
    assert set(kept[3]) == set(kept[2]) and not any(sum(base_spans(t)[:3]) for t in kept[3].values())
    assert all(len(words(kept[3][d])) <= len(words(kept[2][d])) for d in kept[3])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_of_odd_rows(spark, sf_dir, odd_documents, no_documents, empty):
    """Nulls in every column, blank and very long texts, repeated rows, clashing extra columns; an empty table."""
    docs = no_documents if empty else odd_documents
    asked = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == corpus_pipeline.COLUMNS, name
        rows = got.collect()
        assert {r["doc_id"] for r in rows} <= asked and (len(rows) == 0) == empty, name
        if name == "secret_scan" and not empty:
            assert len(rows) == docs.count() and not any(sum(base_spans(r["text"])[:3]) for r in rows)
        if name == "decontamination":
            assert len(rows) == docs.count()
    packed = corpus_pipeline.packed(spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == asked


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.count() == packed.select("sequence_id", "offset").distinct().count()
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()


def test_workers_find_the_package_from_any_folder(sf_dir, tmp_path):
    """A driver started elsewhere, with nothing on PYTHONPATH."""
    code = f"""import sys; sys.path.insert(0, {os.path.dirname(os.path.abspath(corpus_pipeline.__file__))!r})
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
print("rows", __spark_entry__.queries()["op9_lm_score"](spark, {sf_dir!r}).count())"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_") and not k.startswith("SPARK_")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in out.stdout, out.stderr[-2000:]
