"""Task manifests and disclosure rules as violations over DataFrames of manifests and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.functions.text import PATTERNS, is_governed
from tractloom.operators import checks

# Task states, evidence types, fields of a manifest, and what a tracked path must not name.
TASK_STATES = ("AUTHORIZED", "IN_PROGRESS", "BLOCKED_FAIL_CLOSED", "COMPLETED_AWAITING_ACCEPTANCE", "ACCEPTED_CLOSED", "REJECTED_OR_REWORK_REQUIRED")
EVIDENCE_TYPES = ("LOCAL_COMMIT", "TEST_PASS", "COMPLETION_REPORT", "FUTURE_PULL_REQUEST", "FUTURE_MERGE")
MANIFEST_FIELDS = (
    "task_id", "title", "capability_owner", "authority_source", "state", "scope", "exclusions", "accepted_input_artifacts", "protected_dependency_logical_ids",
    "implementation_branch", "implementation_commit", "completion_state", "acceptance_destination", "acceptance_disposition", "acceptance_metadata", "exact_next_destination",
)
PROHIBITED_TERMS = frozenset(
    "absolute_path path coordinate coordinates latitude longitude nonce digest target_cell_address cell_address protected_registry protected_lineage protected_package target_value forecast_value".split()
)


OPTIONAL_FIELDS = ("implementation_commit", "acceptance_disposition", "acceptance_metadata")


def manifest_violations(manifests: DataFrame) -> list[DataFrame]:
    """Rules of task manifests, in the order they are reported.

    Columns as MANIFEST_FIELDS, null for an absent optional one; scope, exclusions and both id lists are array<string>;
    completion_state is struct<execution, implementation_evidence: array, capability_acceptance>; acceptance_metadata
    is struct<capability_owner, recorded_by, recorded_on>.
    """
    if missing := sorted(set(MANIFEST_FIELDS) - set(OPTIONAL_FIELDS) - set(manifests.columns)):
        raise checks.ConformanceError("TASK_MANIFEST_REQUIRED_FIELD_MISSING", str(missing))
    if other := sorted(set(manifests.columns) - set(MANIFEST_FIELDS)):
        raise checks.ConformanceError("TASK_MANIFEST_FIELD_PROHIBITED", str(other))
    key, done = F.col("task_id"), F.col("completion_state")
    lists = {"scope": None, "exclusions": None, "accepted_input_artifacts": "logical_artifact", "protected_dependency_logical_ids": "protected_logical_id"}
    has = set(manifests.columns)

    def optional(name: str, test: Column) -> Column:
        return F.col(name).isNull() | test if name in has else F.lit(True)

    meta = F.col("acceptance_metadata")
    whole = F.forall(F.array(*[meta[k] for k in ("capability_owner", "recorded_by", "recorded_on")]), lambda x: F.coalesce(F.length(x) > 0, F.lit(False))) if "acceptance_metadata" in has else F.lit(True)
    accepted = (F.col("acceptance_disposition") == "ACCEPTED") & meta.isNotNull() if {"acceptance_disposition", "acceptance_metadata"} <= has else F.lit(False)
    rules = [
        ("TASK_ID_INVALID", is_governed(key, "task_id")),
        ("TASK_STATE_INVALID", F.col("state").isin(*TASK_STATES)),
        *[("TASK_MANIFEST_FIELD_INVALID", F.length(c) > 0) for c in ("title", "capability_owner", "authority_source", "acceptance_destination", "exact_next_destination")],
        *[("TASK_MANIFEST_FIELD_INVALID", F.forall(c, lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))) for c in lists],
        *[("TASK_MANIFEST_LOGICAL_ID_INVALID", all_like(c, k)) for c, k in lists.items() if k],
        ("TASK_BRANCH_INVALID", is_governed(F.col("implementation_branch"), "branch") & F.col("implementation_branch").startswith(F.concat(F.lit("task/"), F.lower(key), F.lit("-")))),
        ("TASK_COMMIT_INVALID", optional("implementation_commit", F.col("implementation_commit").rlike(r"\A[0-9a-f]{7,64}\z"))),
        ("TASK_COMPLETION_EXECUTION_INVALID", done["execution"].isin("NOT_STARTED", "IN_PROGRESS", "BLOCKED", "COMPLETED")),
        ("TASK_EVIDENCE_INVALID", F.size(F.array_except(done["implementation_evidence"], F.array(*[F.lit(x) for x in EVIDENCE_TYPES]))) == 0),
        ("TASK_ACCEPTANCE_STATE_INVALID", done["capability_acceptance"].isin("NOT_REVIEWED", "ACCEPTED", "REJECTED_OR_REWORK_REQUIRED")),
        ("TASK_ACCEPTANCE_DISPOSITION_INVALID", optional("acceptance_disposition", F.col("acceptance_disposition").isin("ACCEPTED", "REJECTED_OR_REWORK_REQUIRED"))),
        ("TASK_ACCEPTANCE_METADATA_INVALID", optional("acceptance_metadata", whole & meta["recorded_on"].rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") if "acceptance_metadata" in has else F.lit(True))),
        ("TASK_COMPLETION_ACCEPTANCE_MISMATCH", (F.col("state") != "COMPLETED_AWAITING_ACCEPTANCE") | ((done["execution"] == "COMPLETED") & (done["capability_acceptance"] == "NOT_REVIEWED"))),
        ("TASK_ACCEPTANCE_METADATA_REQUIRED", (F.col("state") != "ACCEPTED_CLOSED") | (accepted & (done["capability_acceptance"] == "ACCEPTED"))),
        ("TASK_MANIFEST_PROTECTED_CONTENT", ~protected_content(F.to_json(F.struct(*[F.col(c) for c in manifests.columns if c != "implementation_commit"])))),
    ]
    return [checks.where_not(manifests, ok, 10 * i, code, key) for i, (code, ok) in enumerate(rules, 1)]


def all_like(name: str, kind: str) -> Column:
    return F.forall(name, lambda x: F.coalesce(x.rlike(PATTERNS[kind]), F.lit(False)))


def protected_content(c: Column) -> Column:
    """Whether a text holds a digest, a coordinate pair or an absolute path."""
    return c.rlike(PATTERNS["sha256"]) | c.rlike(PATTERNS["coordinate_pair"]) | c.rlike(r'"(?:[A-Za-z]:[\\/]|/|~[\\/])')


def retry_violations(previous: DataFrame, correction: DataFrame) -> list[DataFrame]:
    """A correction keeps its task's id, and both manifests are valid."""
    changed = correction.select("task_id").join(previous.select("task_id"), "task_id", "left_anti")
    return [checks.violations(changed, 5, "TASK_ID_MUTATION_REJECTED", F.col("task_id")), *manifest_violations(previous), *manifest_violations(correction)]


def protected_paths(paths: DataFrame, names: list[str], exempt: tuple[str, ...] = ("schemas", "synthetic")) -> DataFrame:
    """Tracked paths whose file name or a folder is protected; paths under an exempt folder pass."""
    parts = F.split(F.lower("path"), "/")
    wanted = F.array(*[F.lit(n.lower()) for n in names])
    free = F.arrays_overlap(parts, F.array(*[F.lit(e) for e in exempt]))
    return paths.where(F.arrays_overlap(parts, wanted) & ~free)


def disclosure_violations(report: DataFrame, allowed: list[str], protected: frozenset[str]) -> list[DataFrame]:
    """A report has exactly the allowed columns and no protected key at any depth."""
    if set(report.columns) != set(allowed):
        raise checks.ConformanceError("DISCLOSURE_FIELDS_INVALID", str(sorted(set(report.columns) ^ set(allowed))))
    return [checks.violations(checks.forbidden_keys(report.sparkSession, report, protected), 10, "DISCLOSURE_PROTECTED_KEY", F.col("key"))]
