"""What the corpus operators share: reading tables, cutting lineage, bounded model fitting samples."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, opened by Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, from spark.checkpoint.dir. Without one a local session gets a temporary folder; on a
    cluster that is an error, as executors would each write to a disk of their own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tractloom-checkpoint-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and read it from there from now on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null where the id is null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def bounded_sample(df: DataFrame, key: str, most: int, seed: int = 11) -> DataFrame:
    """At most `most` rows, those of the smallest key hashes: the same rows in every run. For fitting models only."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key).limit(most)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, most: dict[int, int], folds: int, hidden: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, label of at most most[value] labelled documents for each label value, none of the hidden fold.

    Only the sampled ids are broadcast, and their number is bounded; the documents are not shuffled. Of several labels
    of a document the largest holds; null labels and ids are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold_of(F.col(doc_id), folds) != hidden))
    known = known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label"))
    parts = [bounded_sample(known.where(F.col("label") == value), "doc_id", n) for value, n in most.items()]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
