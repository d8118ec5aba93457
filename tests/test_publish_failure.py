import pytest
from pyspark.sql import functions as F

from tractloom import publish


def test_a_failed_task_leaves_no_marked_run(spark, tmp_path):
    """A task that fails in the middle of a table ends the run before its manifest and marker; the folder is not used again."""
    out = str(tmp_path / "run")
    good = spark.range(100)
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        publish.publish(spark, out, {"good": good, "bad": bad}, [], dependencies={"source": "x"}, required=("source",), nonce=bytes(32))
    assert not publish.exists(spark, f"{out}/{publish.MARKER}") and not publish.exists(spark, f"{out}/tables/bad/_SUCCESS")
    with pytest.raises(Exception):
        publish.reconcile(spark, out, bytes(32))
