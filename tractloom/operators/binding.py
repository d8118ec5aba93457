"""Binding of requested pairs to worksheet rows, of locations to addresses, and of manifests to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractloom.operators import checks


def bind_requests(requests: DataFrame, sheet: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """requests (lineage_key, vintage_year, ...) with the target_address of the sheet's row, and the violations.

    sheet: lineage_key, vintage_year, target_address; rows nobody asked for are ignored, as an inner join does.
    """
    keys = ["lineage_key", "vintage_year"]
    asked = sheet.join(requests.select(*keys).distinct(), keys, "left_semi")
    return requests.join(sheet.select(*keys, "target_address"), keys), [
        checks.duplicates(requests, keys, 10, "TARGET_REQUEST_DUPLICATE"),
        checks.duplicates(asked, keys, 20, "TARGET_JOIN_AMBIGUOUS"),
        checks.not_covered(requests, sheet, keys, 30, "TARGET_JOIN_UNRESOLVED"),
    ]


def pair_by_role(bound: DataFrame, roles: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """A row per location with one address column per role, and violations where a role is missing or repeated."""
    wide = bound.groupBy("physical_location_id").pivot("source_role", roles).agg(F.first("target_address"))
    whole = wide.select("physical_location_id", F.forall(F.array(*[F.col(f"`{r}`") for r in roles]), lambda x: x.isNotNull()).alias("ok"))
    return wide, [
        checks.duplicates(bound, ["physical_location_id", "source_role"], 10, "PAIR_ROLE_DUPLICATE"),
        checks.where_not(whole, F.col("ok"), 20, "PAIR_ROLE_MISSING", F.col("physical_location_id")),
    ]


def reconcile_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """name, expected, actual and state (match, differs, missing, extra) of every artifact of either side.

    manifest: name, sha256. files: name, sha256, e.g. of `hashed_files`.
    """
    m, f = manifest.select("name", F.col("sha256").alias("expected")), files.select("name", F.col("sha256").alias("actual"))
    state = F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra").when(F.col("expected") == F.col("actual"), "match").otherwise("differs")
    return m.join(f, "name", "full_outer").withColumn("state", state)


def hashed_files(spark, path: str) -> DataFrame:
    """name and sha256 of the files under a path; large files stay in their tasks."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def reconcile_maps(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Keys whose values differ or that one side lacks; values are not shown."""
    e, a = expected.select("key", F.col("value").alias("e"), F.lit(True).alias("in_e")), actual.select("key", F.col("value").alias("a"), F.lit(True).alias("in_a"))
    j = e.join(a, "key", "full_outer")
    return j.where(F.col("in_e").isNull() | F.col("in_a").isNull() | ~F.col("e").eqNullSafe(F.col("a"))).select("key")


def context_artifacts(pairs: DataFrame, kinds: list[str]) -> DataFrame:
    """Names of the frozen artifacts each location needs, by its context ordinal."""
    kind = F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")
    return pairs.select("physical_location_id", "pipe_context_ordinal", kind).withColumn("name", F.format_string("context-%04d-%s.json", "pipe_context_ordinal", "kind"))
