"""The corpus pipeline: five operators in a row over `documents`, each stage written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Models are fitted from `labels` on
the documents at hand. A stage's result does not depend on other stages' internals, so a lost executor costs its tasks
alone, and what is written stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.llm import decontaminate, mixing, quality, simhash, toxicity
from tractloom.llm.common import shared_folder, table

REJECTED_FROM = 0.7


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7 stay."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, out="__quality").where(F.col("__quality") >= REJECTED_FROM).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7 stay."""
    grammar = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, grammar, out="__toxicity").where(F.col("__toxicity") < REJECTED_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, by the operator's own contract (3 words, 2 bits)."""
    return simhash.keep_representatives(docs).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark hit on at least one word in twenty go."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), outcome="__contamination")
    return decontaminate.drop_documents(found, "__contamination").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet their targets."""
    made = mixing.mix(docs)
    return made.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Models and connected components are not SQL; the tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read as the next's docs.

    folder: where the stages are written, by default a new one in the shared folder. A run that is given the folder of one
    that was cut short goes on after the last stage that was written whole. A stage's files are removed when the next one
    is written, so the last stage's stay.
    """
    docs = table(spark, sf_dir, "documents")
    top = folder or f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(f"{top}/{k}-{name}") for k, (name, _) in enumerate(STAGES)]
    files = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")) for p in paths]
    first = max((k + 1 for k, d in enumerate(done) if d), default=0)
    if first:
        docs = spark.read.parquet(paths[first - 1].toString())
    for k in range(first, len(STAGES)):
        STAGES[k][1](spark, docs, sf_dir).write.mode("overwrite").parquet(paths[k].toString())
        docs = spark.read.parquet(paths[k].toString())
        if k:
            files.delete(paths[k - 1], True)
    return docs
