"""Publishing: checks first, tables next, the manifest after them, the marker last.

Everything is written through Spark, so any store that Spark reaches will do. A run folder is never reused: its first
write fails if it exists, and a run without its marker was not finished.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.functions.canonical import commitment_of, hexdigest, written
from tractloom.operators import checks

MARKER = "FROZEN"


def fingerprint(df: DataFrame) -> dict:
    """Row count and an order-free sum of row hashes, by one partial aggregation."""
    if not df.columns:
        return {"rows": df.count(), "sum": "0"}
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("s")).first()
    return {"rows": r.n, "sum": r.s}


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """A canonical JSON document as a one-line text folder; an existing one is an error."""
    spark.createDataFrame([(written(document),)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(found, dict):
        raise checks.ConformanceError("JSON_OBJECT_REQUIRED", path)
    return found


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_once(spark: SparkSession, path: str, document: dict) -> bool:
    """Write a document; the same one again is no change, a different one an error. Whether it was written."""
    if exists(spark, path):
        if written(read_document(spark, path)) != written(document):
            raise checks.ConformanceError("IMMUTABLE_DOCUMENT_DIFFERS", path)
        return False
    write_document(spark, path, document)
    return True


def publish(
    spark: SparkSession, out: str, tables: dict[str, DataFrame], violations: list[DataFrame], *, dependencies: dict[str, str], required: tuple[str, ...] = (), forbidden: frozenset[str] = frozenset(),
    nonce: bytes | None = None, version: str = "1.0.0", supersedes: str | None = None,
) -> dict:
    """Check, write tables/<name> as Parquet, then manifest, commitment and marker. Returns the manifest.

    supersedes: the folder of a frozen run that this one takes the place of; it must have another version.
    """
    if supersedes is not None:
        if not is_frozen(spark, supersedes):
            raise checks.ConformanceError("RUN_NOT_FROZEN", supersedes)
        if read_document(spark, f"{supersedes}/manifest")["version"] == version:
            raise checks.ConformanceError("SUPERSESSION_NEEDS_NEW_VERSION", version)
    if missing := sorted(set(required) - {k for k, v in dependencies.items() if v}):
        raise checks.ConformanceError("MANDATORY_DEPENDENCY_MISSING", str(missing))
    for name, df in tables.items():
        if not name.replace("_", "").isalnum():
            raise checks.ConformanceError("ARTIFACT_NAME_INVALID", name)
        if forbidden:
            checks.require_none([checks.violations(checks.forbidden_keys(spark, df, forbidden), 1, "TARGET_INPUT_REJECTED", F.col("key"))])
    checks.require_none(violations)
    if exists(spark, out):
        raise checks.ConformanceError("RUN_ALREADY_EXISTS", out)
    write_document(spark, f"{out}/run_state", {"state": "incomplete"})
    artifacts = {}
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{out}/tables/{name}")
        artifacts[name] = fingerprint(spark.read.parquet(f"{out}/tables/{name}"))
    manifest = {"artifacts": artifacts, "dependencies": dependencies, "version": version, "supersedes": supersedes}
    write_document(spark, f"{out}/manifest", manifest)
    if nonce is not None:
        write_document(spark, f"{out}/commitment", {"commitment": commitment_of(hexdigest(manifest), nonce)})
    write_document(spark, f"{out}/{MARKER}", {"manifest_sha256": hexdigest(manifest)})
    return manifest


def is_frozen(spark: SparkSession, out: str) -> bool:
    return exists(spark, f"{out}/{MARKER}")


def reconcile(spark: SparkSession, out: str, nonce: bytes | None = None) -> dict:
    """The manifest of a frozen run after its marker, commitment and every table were checked against it."""
    if not is_frozen(spark, out):
        raise checks.ConformanceError("RUN_NOT_FROZEN", out)
    manifest = read_document(spark, f"{out}/manifest")
    if read_document(spark, f"{out}/{MARKER}")["manifest_sha256"] != hexdigest(manifest):
        raise checks.ConformanceError("MANIFEST_HASH_MISMATCH", out)
    if nonce is not None and read_document(spark, f"{out}/commitment")["commitment"] != commitment_of(hexdigest(manifest), nonce):
        raise checks.ConformanceError("COMMITMENT_MISMATCH", out)
    for name, stated in manifest["artifacts"].items():
        if fingerprint(spark.read.parquet(f"{out}/tables/{name}")) != stated:
            raise checks.ConformanceError("ARTIFACT_HASH_MISMATCH", name)
    return manifest
