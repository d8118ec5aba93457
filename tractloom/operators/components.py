"""Connected components of an edge table, by alternating large and small stars.

Every round is two joins over the edges; what one vertex has many of (a star's centre) is pre-aggregated before its
shuffle or split by the join. Lineage is cut by checkpoints in the shared folder, and neither edges nor components ever
come to the driver: only a count and a checksum of the edges do.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Without one a local session gets a temporary folder; on a cluster that is an
    error, as executors would each write to a disk of their own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tractloom-checkpoint-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it from there from now on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """vertex, root (the smallest vertex of its component) for every vertex of edges (a, b), of any ordered type.

    Self-loops and nulls are no edges; repeated and reversed edges count once. An empty table gives an empty one.
    """
    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # Large star: every vertex points its larger neighbours at the smallest it sees.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every vertex points its smaller neighbours and itself at the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
            return roots.unionByName(e.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
