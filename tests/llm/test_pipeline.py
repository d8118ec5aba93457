import os

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from tractloom.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_says_the_same(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    r = c.execute(queries.ORACLE_SQL[name])
    at = [x[0] for x in r.description]
    want = sorted((tuple(row[at.index(k)] for k in sorted(at)) for row in r.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(at) and sorted((tuple(row[k] for k in sorted(at)) for row in df.collect()), key=repr) == want


def test_stages(spark):
    """Every stage keeps a subset, and what it drops is what the operators say."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= before and len(kept) > 0.6 * len(before), name
        labels = spark.read.parquet(f"{SF}/labels.parquet")
        if name == "quality":
            assert docs.join(labels.where("quality = 1"), "doc_id").count() - out.join(labels.where("quality = 1"), "doc_id").count() <= 1
        if name == "decontamination":
            left = decontaminate.find_contamination(out, spark.read.parquet(f"{SF}/benchmark.parquet")).where(decontaminate.is_contaminated()).count()
            assert left == 0
        docs, before = spark.createDataFrame(out.collect(), out.schema), kept
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.count() == docs.count() and mixed.where(F.col("taken") > 3 * F.col("size")).count() == 0


def test_run_and_odd_rows(spark, tmp_path):
    """Odd rows, empty tables and clashing extra columns; reruns keep the same documents and go on where they stopped."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "words here to keep", "en", "s", 1), (900001, None, "en", None, 0), (900002, "", None, "s", 0), (900001, None, "en", None, 0)], docs.schema)
    clash = {c: F.lit("clash") for c in ("toxicity", "quality_score", "fp", "copies", "size", "contamination", "label", "n_words")}
    docs.unionByName(odd).withColumns(clash).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").withColumn("text" if t == "labels" else "doc_id", F.lit("clash")).write.parquet(f"{tmp_path}/{t}.parquet")
    folder = f"{tmp_path}/stages"
    first = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path), folder).collect()))
    assert len(first) > 100 and first == sorted(map(str, corpus_pipeline.run(spark, str(tmp_path), folder).collect()))
    assert sorted(os.listdir(folder)) == ["4-mixing"]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_all_queries_run(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages"))
    for name, q in queries.QUERIES.items():
        assert q(spark, SF).count() == (pages if name.startswith(("op5_", "op8_")) else docs), name
