"""Pipe-delimited household tables by Spark's text reader: splittable, BOM-tolerant, with every cell kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.functions.households import parsed
from tractloom.operators import checks

TRACT_PREFIX = "1400000US"


def clean_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "\\A\ufeff|\\r\\z", "").alias("line"))


def header_of(spark: SparkSession, path: str, needed: list[str], rows: str = TRACT_PREFIX) -> list[str]:
    """The files' own header: the one line that names all needed columns and is no data row. Files whose headers differ,
    or that have none, are an error."""
    named = F.split("line", "\\|", -1)
    has = F.lit(True)
    for c in needed:
        has = has & F.array_contains(named, c)
    found = [r.line for r in clean_lines(spark, path).where(has & ~F.col("line").contains(rows)).distinct().limit(2).collect()]
    if len(found) != 1:
        raise checks.ConformanceError("ACS_SOURCE_HEADER_MISMATCH", "no header with " + ", ".join(needed) if not found else "files differ in their headers")
    columns = found[0].split("|")
    if repeated := sorted({c for c in columns if columns.count(c) > 1}):
        raise checks.ConformanceError("ACS_SOURCE_HEADER_MISMATCH", f"repeated columns {repeated}")
    return columns


def read_household_file(spark: SparkSession, path: str, header: list[str] | None = None, state: str = "55", key: str = "GEO_ID", estimate: str = "B11001_E001", moe: str = "B11001_M001") -> tuple[DataFrame, list[DataFrame]]:
    """Rows (tract_geoid, raw_estimate, raw_moe, estimate, moe, status, status_detail) of a state's tracts, and violations.

    Columns are found by the file's own header. Where `header` is given the file's must be equal, in order. Short lines
    give nulls for the columns they lack; long lines are violations. The state filter comes before any token is parsed.
    """
    own = header_of(spark, path, [key, estimate, moe])
    if header is not None and own != list(header):
        raise checks.ConformanceError("ACS_SOURCE_HEADER_MISMATCH", "|".join(own)[:200])
    lines = clean_lines(spark, path).where(F.col("line") != "|".join(own))
    cells = F.split("line", "\\|", -1)
    rows = lines.where(F.size(cells) <= len(own)).select(*[F.try_element_at(cells, F.lit(own.index(c) + 1)).alias(c) for c in (key, estimate, moe)])
    rows = rows.where(F.col(key).startswith(TRACT_PREFIX + state))
    geoid = F.regexp_extract(key, rf"\A{TRACT_PREFIX}([0-9]{{11}})\z", 1)
    made = rows.withColumn("tract_geoid", geoid).withColumn("__p", parsed(F.col(estimate), F.col(moe)))
    made = made.select("tract_geoid", F.col(estimate).alias("raw_estimate"), F.col(moe).alias("raw_moe"), "__p.*")
    return made, [
        checks.violations(lines.where(F.size(cells) > len(own)), 10, "ACS_SOURCE_ROW_MALFORMED", F.substring("line", 1, 40)),
        checks.where_not(made, F.col("tract_geoid") != "", 20, "ACS_TRACT_IDENTITY_INVALID", F.col("tract_geoid")),
        checks.duplicates(made, ["tract_geoid"], 30, "ACS_DUPLICATE_TRACT_GEOID"),
    ]
