"""What runs are held to: stated counts, pinned bytes, allow-listed fields, the projection's parameters, and context ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.functions import coordinates
from tractloom.functions.canonical import hexdigest, id_column
from tractloom.operators import checks

CONTEXT_DOMAIN = "tractloom/context-instance/v1"
LINEAGE = ("source_workbook_identity", "source_sheet", "source_row", "source_seed_point_id")


def context_instance_id(package: Column, specification: Column, record: Column, rows: DataFrame | None = None, domain: str = CONTEXT_DOMAIN) -> Column:
    """The content id of a context from ten fields: the domain; the package's id, version and digest (a struct of
    package_id, package_version, sha256); the record's lineage; the specification's id and digest (artifact_id, sha256)."""
    named = {"domain": F.lit(domain)}
    named |= {f"package_{k}": package[c] for k, c in (("id", "package_id"), ("version", "package_version"), ("sha256", "sha256"))}
    named |= {c: record[c] for c in LINEAGE}
    named |= {f"specification_{k}": specification[c] for k, c in (("id", "artifact_id"), ("sha256", "sha256"))}
    return id_column("context_instance", F.struct(*[v.alias(k) for k, v in named.items()]), rows)


def count_violations(df: DataFrame, expected: int, order: int, code: str) -> DataFrame:
    """One violation if df has not exactly the expected number of rows."""
    return checks.violations(df.agg(F.count("*").alias("n")).where(F.col("n") != expected), order, code, F.lit(""), F.concat(F.col("n").cast("string"), F.lit(f" of {expected}")))


def count_qa(df: DataFrame, by: str, expectations: DataFrame) -> DataFrame:
    """`by`, n, expected, count_qa: whether each group has its expected number of rows; null where none is stated.

    expectations: `by` and expected. A flag for review and no rule; groups that are expected and absent have n = 0.
    """
    counted = df.groupBy(by).agg(F.count("*").alias("n"))
    both = counted.join(expectations.select(by, "expected"), by, "full")
    n = F.coalesce("n", F.lit(0))
    return both.select(by, n.alias("n"), "expected", (n == F.col("expected")).alias("count_qa"))


@dataclass(frozen=True)
class ProjectionPolicy:
    """Default-deny: only these fields, of rows of this market and role that are not quarantined and are on the list."""

    fields: frozenset[str]
    market: str
    role: str


def project(df: DataFrame, policy: ProjectionPolicy, wanted: list[str], allowed_rows: DataFrame, key: str) -> DataFrame:
    """The wanted fields of the rows that the policy and the list of keys allow; a field beyond the policy raises.

    df: market, evidence_role, quarantined, `key` and the fields. Unknown market, role or quarantine is denied.
    """
    if denied := sorted(set(wanted) - policy.fields):
        raise checks.ConformanceError("TARGET_PROJECTION_DENIED", str(denied))
    inside = (F.col("market") == policy.market) & (F.col("evidence_role") == policy.role) & ~F.col("quarantined")
    return df.where(inside).join(allowed_rows.select(key).distinct(), key, "left_semi").select(*wanted)


def read_pinned(spark: SparkSession, path: str, pins: DataFrame) -> DataFrame:
    """path and content of files whose digest and length are as pinned; any other file, or a pin without a file, fails the job.

    pins: name (the last part of the path), sha256 and length. The digest is taken where the file is read.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content", F.element_at(F.split("path", "/"), -1).alias("name"))
    stated = pins.select("name", F.lower("sha256").alias("__sha"), F.col("length").alias("__length"))
    j = files.join(F.broadcast(stated), "name", "full")
    equal = F.coalesce((F.sha2("content", 256) == F.col("__sha")) & (F.col("length") == F.col("__length")), F.lit(False))
    return j.select("path", F.when(equal, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("SOURCE_CHECKSUM_MISMATCH: "), F.col("name")))).alias("content"))


def projection_parameters() -> dict:
    """What the projection computes with, as a document; its digest is the fingerprint that a run states."""
    c = coordinates
    return {"ellipsoid_a": c.GRS80_A, "method": "albers_equal_area", "lat_0": c.LAT_0, "lon_0": c.LON_0, "parallels": [c.PARALLEL_1, c.PARALLEL_2], "derived": list(c.albers_constants())}


def require_projection(fingerprint: str) -> None:
    """Raise unless a run's stated fingerprint is that of the projection in use."""
    if fingerprint != hexdigest(projection_parameters()):
        raise checks.ConformanceError("TRANSFORMER_CONFORMANCE_INVALID", fingerprint)
