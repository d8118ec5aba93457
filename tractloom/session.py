"""Session defaults. A cluster's own settings always win over these."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tractloom") -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session to the operators."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRACTLOOM_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables; Spark's reader alone opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
