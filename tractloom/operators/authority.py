"""Documents under rules: contracts, manifests, specifications and packages as rows, their checks as joins.

A JSON document is dealt out into nodes, one row for each object, array and scalar, with its path. A rule is a filter or a
join over nodes and gives violations like any other check, so one document, a million of them, or one package with a
million cells take the same plan, and rules across documents are joins. A path names the keys with dots between and []
for any element of an array; a node's value is its canonical text, so whole objects compare like scalars.

Text that is no JSON gives the single node of kind `unreadable`; null text gives none, so its fields are absent.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.functions.canonical import canonical_column, digest_column, hexdigest, written
from tractloom.operators import checks

NODE_TYPE = "array<struct<path:string,parent:string,at:array<int>,key:string,kind:string,value:string>>"
NODE_LIST = pa.list_(pa.struct([("path", pa.string()), ("parent", pa.string()), ("at", pa.list_(pa.int32())), ("key", pa.string()), ("kind", pa.string()), ("value", pa.string())]))
KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}
MOST_TRACTS = 200_000  # of one inventory document; the country has fewer than half as many

# Fields and states that documents must state, as they are written in them.
MOVING_KEYS = ("accepted_vintage", "product", "source_reference", "vintage")
MOVING_WORDS = "latest|current"
CONTRACT_FIELDS = ("status", "controlling_decision", "purpose", "accepted_sources", "content_hash_semantics", "supersession_policy", "failure_behavior")
MANIFEST_FIELDS = (
    "manifest_id", "manifest_version", "source_id", "source_name", "publisher", "accepted_vintage", "source_reference", "official_product_identity", "source_filename", "checksum_algorithm", "byte_sha256",
    "checksum_semantics", "acquisition_state", "schema_version", "lineage", "expected_file_properties", "reproduction", "failure_behavior", "supersession_policy", "manifest_content_sha256",
)
PREREGISTERED = {
    "spatial_contexts.primary": {"statute_miles": 5, "metres": 8046.72},
    "spatial_contexts.sensitivity": [{"statute_miles": 3, "metres": 4828.032}, {"statute_miles": 7, "metres": 11265.408}],
    "prospective_candidate_state.eligible_candidates": ["BASELINE_HOUSEHOLD"],
    "prospective_candidate_state.champion_state": "NO_CUSTOMER_FIT_CHAMPION_CANDIDATE",
    "ranking_and_level.primary_metric": "Kendall tau-b",
    "ranking_and_level.directional_materiality_threshold": 0.2,
    "dependence.stress_grouping_jaccard_threshold": 0.25,
    "geometric_completeness.primary_minimum": 0.9,
    "geometric_completeness.secondary_minimum": 0.75,
    "validation.stage_order": [
        "MILWAUKEE_TEMPORAL_VALIDATION", "MILWAUKEE_PROSPECTIVE_NEW_LOCATION_VALIDATION", "MADISON_HISTORICAL_REPEATED_LOCATION_EXTERNAL_VALIDATION", "MADISON_2026_GENUINELY_NEW_LOCATION_EXTERNAL_VALIDATION",
    ],
    "target_governance.state_progression": ["SEALED", "EVALUATION_AUTHORIZED", "EVALUATED_FROZEN", "DIAGNOSTICS_CONSUMED", "DEVELOPMENT_CONSUMED"],
}
PREREGISTRATION_FIELDS = ("artifact_id", "version", "canonical_schema_version", "content_sha256", "dependencies", "spatial_contexts", "prospective_candidate_state", "ranking_and_level", "validation", "target_governance", "supersedes")
PACKAGE_FIELDS = (
    "$schema", "package_id", "version", "binding_run_id", "state", "model_authority", "model05_authority", "pipe01_authority", "target_source_authorities", "temporal_eligibility_mapping",
    "minimum_target_projection", "protected_handle_registry_identity", "finalization", "supersedes", "supersession_policy",
)
SOURCE_ROLES = ("CURRENT_2026_TEMPORAL_SOURCE", "PRIOR_VINTAGE_TEMPORAL_SOURCE")


# ---- nodes ----------------------------------------------------------------------------------------------------------


def dealt_out(text: str | None) -> list[dict]:
    """The nodes of one document, parents before children."""
    if text is None:
        return []
    try:
        stack = [(json.loads(text), "", None, (), None)]
        found = []
        while stack:
            x, path, parent, at, key = stack.pop()
            found.append({"path": path, "parent": parent, "at": at, "key": key, "kind": KINDS[type(x)], "value": written(x)})
            if isinstance(x, dict):
                stack.extend((v, f"{path}.{k}" if path else k, path, at, k) for k, v in x.items())
            elif isinstance(x, list):
                stack.extend((v, f"{path}[]", path, (*at, i), None) for i, v in enumerate(x))
    except (ValueError, RecursionError):
        return [{"path": "", "parent": None, "at": (), "key": None, "kind": "unreadable", "value": None}]
    return found


def nodes(documents: DataFrame, document: str = "document", body: str = "body") -> DataFrame:
    """document, path, parent, at (positions in the arrays passed), key, kind, value for every node of every document."""

    @F.arrow_udf(NODE_TYPE)
    def dealt(texts: pa.Array) -> pa.Array:
        return pa.array([dealt_out(t) for t in texts.to_pylist()], type=NODE_LIST)

    return documents.select(F.col(document).alias("document"), F.explode(dealt(F.col(body))).alias("n")).select("document", "n.*")


def places(n: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """The few places a rule speaks of, for a broadcast."""
    return F.broadcast(n.sparkSession.createDataFrame(rows, schema))


def named(*extra: str) -> Column:
    return F.concat_ws(":", "document", "path", *extra)


# ---- rules ----------------------------------------------------------------------------------------------------------


def readable(n: DataFrame, order: int, code: str) -> DataFrame:
    return checks.violations(n.where("kind = 'unreadable'"), order, code, F.col("document"))


def present(n: DataFrame, wanted: list[tuple[str, str]], order: int, code: str) -> DataFrame:
    """(document, path) that has no node, or none but nulls and empty strings."""
    w = places(n, wanted, "document string, path string")
    there = n.where("kind <> 'null' and value <> '\"\"'").join(w, ["document", "path"], "left_semi").select("document", "path").distinct()
    return checks.violations(w.join(there, ["document", "path"], "left_anti"), order, code, named())


def equal(n: DataFrame, stated: list[tuple[str, str, object]], order: int, code: str) -> DataFrame:
    """(document, path, value): there is a node at the path, and all that are there have the value."""
    s = places(n, [(d, p, written(v)) for d, p, v in stated], "document string, path string, stated string")
    met = n.join(s, ["document", "path"])
    absent = s.join(met.select("document", "path").distinct(), ["document", "path"], "left_anti")
    return checks.violations(met.where("value <> stated").select("document", "path", "value"), order, code, named(), F.col("value")).unionByName(checks.violations(absent, order, code, named(), "absent"))


def same(n: DataFrame, links: list[tuple[str, str, str, str]], order: int, code: str, *, both: bool = True) -> DataFrame:
    """(document, path, other document, other path): the values at the first are those at the other, and there is one.

    Without `both` the other side may have more. Scalars are sets of one value.
    """
    numbered = [(i, *link) for i, link in enumerate(links)]
    left = n.join(places(n, [r[:3] for r in numbered], "link int, document string, path string"), ["document", "path"]).select("link", "value").distinct()
    right = n.join(places(n, [(r[0], *r[3:]) for r in numbered], "link int, document string, path string"), ["document", "path"]).select("link", "value").distinct()
    every = places(n, [(i, ":".join(link)) for i, link in enumerate(links)], "link int, said string")
    apart = left.join(right, ["link", "value"], "left_anti")
    if both:
        apart = apart.unionByName(right.join(left, ["link", "value"], "left_anti"))
    wrong = apart.join(every, "link").select("said", "value").unionByName(every.join(left, "link", "left_anti").select("said", F.lit(None).cast("string").alias("value")))
    return checks.violations(wrong, order, code, F.col("said"), F.col("value"))


def distinct(n: DataFrame, at: list[tuple[str, str]], order: int, code: str) -> DataFrame:
    """Values that a list path of a document has more than once."""
    there = n.join(places(n, at, "document string, path string"), ["document", "path"], "left_semi")
    return checks.duplicates(there, ["document", "path", "value"], order, code)


def exact_fields(n: DataFrame, document: str, path: str, fields: tuple[str, ...], order: int, code: str) -> DataFrame:
    """Every object at the path has these fields and no other."""
    mine = n.where(F.col("document") == document)
    have = mine.where(F.col("parent") == path).select("at", "key").where("key is not null")
    owed = mine.where((F.col("path") == path) & (F.col("kind") == "object")).select("at", F.explode(F.array(*map(F.lit, fields))).alias("key"))
    wrong = owed.join(have, ["at", "key"], "left_anti").unionByName(have.where(~F.col("key").isin(*fields)))
    return checks.violations(wrong, order, code, F.concat_ws(":", F.lit(document), F.lit(path), "key"))


def moves() -> Column:
    """Whether a node's identity names a moving release."""
    return F.col("key").isin(*MOVING_KEYS) & (F.col("kind") == "string") & F.lower("value").rlike(MOVING_WORDS)


def moving(n: DataFrame, order: int, code: str) -> DataFrame:
    """Identities that name a moving release instead of a fixed one, at any depth."""
    return checks.violations(n.where(moves()), order, code, named(), F.col("value"))


def digests(n: DataFrame, links: list[tuple[str, str, str, str]], order: int, code: str) -> DataFrame:
    """(document, path, other document, other path): the other states the digest of the first's canonical text."""
    numbered = [(i, *link) for i, link in enumerate(links)]
    made = n.join(places(n, [r[:3] for r in numbered], "link int, document string, path string"), ["document", "path"]).select("link", F.concat(F.lit('"'), F.sha2("value", 256), F.lit('"')).alias("value"))
    stated = n.join(places(n, [(r[0], *r[3:]) for r in numbered], "link int, document string, path string"), ["document", "path"]).select("link", "value")
    every = places(n, [(i, ":".join(link)) for i, link in enumerate(links)], "link int, said string")
    return checks.violations(every.join(made.join(stated, ["link", "value"]), "link", "left_anti"), order, code, F.col("said"))


def sealed(documents: DataFrame, field: str, order: int, code: str, document: str = "document", body: str = "body") -> DataFrame:
    """Documents whose field is not the digest of the rest of them."""

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            try:
                x = json.loads(t or "null")
                stated = x.pop(field, None) if isinstance(x, dict) else None
                out.append(stated is not None and stated == hexdigest(x))
            except (ValueError, RecursionError):
                out.append(False)
        return pa.array(out, type=pa.bool_())

    return checks.where_not(documents, holds(F.col(body)), order, code, F.col(document))


# ---- what the kinds of documents are held to ------------------------------------------------------------------------


def contract_rules(documents: DataFrame, contract: str, manifests: dict[str, str], version: str = "1.0.0", vintage: str = "2024") -> list[DataFrame]:
    """A data contract and its source manifests (document name to source family): complete, of this version and vintage,
    without moving identities, sealed, and the contract names exactly these manifests."""
    used = documents.where(F.col("document").isin(contract, *manifests))
    n, names = nodes(used), list(manifests)
    per = lambda fields: [(m, f) for m in names for f in fields]
    return [
        readable(n, 1, "JSON_OBJECT_REQUIRED"),
        equal(n, [(contract, "version", version), (contract, "hash_algorithm", "SHA-256")], 2, "DATA_CONFIG_VERSION_MISMATCH"),
        present(n, [(contract, f) for f in CONTRACT_FIELDS], 3, "DATA_CONFIG_INCOMPLETE"),
        moving(n, 4, "DATA_MOVING_IDENTITY_REJECTED"),
        distinct(n, [(contract, "accepted_sources[].family")], 5, "DATA_CONFIG_SOURCES_INVALID"),
        present(n, per(MANIFEST_FIELDS), 6, "DATA_MANIFEST_INCOMPLETE"),
        equal(n, [(m, *kv) for m in names for kv in (("manifest_version", version), ("accepted_vintage", vintage), ("checksum_algorithm", "SHA-256"), ("acquisition_state", "acquired"))], 7, "DATA_MANIFEST_STATE_MISMATCH"),
        same(n, [(m, "manifest_id", contract, "accepted_sources[].source_manifest_id") for m in names], 8, "DATA_CONFIG_MANIFEST_REFERENCE_MISMATCH", both=False),
        families(n, contract, manifests, 9, "DATA_CONFIG_SOURCES_INVALID"),
        sealed(used.where(F.col("document") == contract), "content_sha256", 10, "CONTENT_HASH_MISMATCH"),
        sealed(used.where(F.col("document") != contract), "manifest_content_sha256", 11, "CONTENT_HASH_MISMATCH"),
    ]


def families(n: DataFrame, contract: str, manifests: dict[str, str], order: int, code: str) -> DataFrame:
    """Families whose entry in the contract does not name that family's manifest."""
    entry = n.where(F.col("document") == contract)
    of = lambda field: entry.where(F.col("path") == f"accepted_sources[].{field}").select("at", F.col("value").alias(field))
    known = places(n, [(m, written(f)) for m, f in manifests.items()], "document string, family string")
    ids = n.where("path = 'manifest_id'").join(known, "document").select("document", "family", "value")
    named_there = of("family").join(of("source_manifest_id"), "at").select("family", F.col("source_manifest_id").alias("value"))
    return checks.violations(ids.join(named_there, ["family", "value"], "left_anti"), order, code, F.col("document"), F.col("family"))


def preregistration_rules(documents: DataFrame, name: str) -> list[DataFrame]:
    """A preregistration has all its fields and its fixed values, and its digest holds."""
    used = documents.where(F.col("document") == name)
    n = nodes(used)
    # `supersedes` may be null; its field may not be absent.
    return [
        present(n, [(name, f) for f in PREREGISTRATION_FIELDS if f != "supersedes"], 1, "MODEL05_PREREGISTRATION_SCHEMA_INVALID"),
        checks.empty(n.where("path = 'supersedes'"), 1, "MODEL05_PREREGISTRATION_SCHEMA_INVALID", "supersedes"),
        sealed(used, "content_sha256", 2, "MODEL05_CONTENT_HASH_MISMATCH"),
        equal(n, [(name, p, v) for p, v in PREREGISTERED.items()], 3, "MODEL05_FROZEN_VALUE_MISMATCH"),
    ]


def package_rules(documents: DataFrame, name: str, fixed: dict[str, object], allowed_fields: tuple[str, ...], roles: tuple[str, ...] = SOURCE_ROLES) -> list[DataFrame]:
    """A binding package: exact fields, fixed values, one authority, projection and audit for each role, one pair of cells
    for each location, and nothing that says a target was read.

    fixed: path to value, for the identities, the version and the commitments this run is bound to.
    """
    n = nodes(documents.where(F.col("document") == name))
    at = lambda *paths: [(name, p) for p in paths]
    all_are = lambda said: [(name, p, v) for p, v in said.items()]
    wanted = n.sparkSession.createDataFrame([(r,) for r in roles], "key string")
    role_of = lambda path: n.where(F.col("path") == path).select(F.regexp_replace("value", '^"|"$', "").alias("key"))
    audited = n.where("parent = 'minimum_target_projection.target_access_audits'").select("key")
    denied = n.where("path = 'minimum_target_projection.source_projections[].denied_scope' and (kind <> 'array' or value = '[]')")
    fields = n.where("path = 'minimum_target_projection.source_projections[].allowed_fields[]'").select(F.slice("at", 1, 1).alias("at"), F.regexp_replace("value", '^"|"$', "").alias("key"))
    projections = n.where("path = 'minimum_target_projection.source_projections[]'").select("at")
    owed = projections.select("at", F.explode(F.array(*map(F.lit, allowed_fields))).alias("key"))
    audits = [f"minimum_target_projection.target_access_audits.{r}" for r in roles]
    cells = "minimum_target_projection.target_cells[]"
    return [
        readable(n, 1, "JSON_OBJECT_REQUIRED"),
        exact_fields(n, name, "", PACKAGE_FIELDS, 2, "BINDING_PACKAGE_SCHEMA_INVALID"),
        equal(n, all_are(fixed), 3, "BINDING_IDENTITY_MISMATCH"),
        equal(n, all_are({"state": "ready", "model_authority.commitment_reconciled": True, "pipe01_authority.upstream_frozen_artifacts_regenerated": False}), 4, "BINDING_STATE_INVALID"),
        *checks.exact_cover(wanted, role_of("target_source_authorities[].source_role"), ["key"], 5, "TARGET_SOURCE_ROLE_INVALID", "TARGET_SOURCE_ROLES_INCOMPLETE"),
        distinct(n, at("target_source_authorities[].workbook_handle"), 7, "TARGET_SOURCE_HANDLE_REUSED"),
        entries_have(n, name, "target_source_authorities[]", ("authority_id", "provenance_class", "workbook_handle"), 8, "TARGET_SOURCE_AUTHORITY_UNRESOLVED"),
        equal(n, all_are({"target_source_authorities[].whole_workbook_hash_computed": False}), 9, "TARGET_SOURCE_HASH_POLICY_INVALID"),
        *checks.exact_cover(wanted, role_of("minimum_target_projection.source_projections[].source_role"), ["key"], 10, "TARGET_SOURCE_PROJECTION_INCOMPLETE", "TARGET_SOURCE_PROJECTION_INCOMPLETE"),
        handles_agree(n, 12, "TARGET_SOURCE_HANDLE_MISMATCH"),
        checks.violations(owed.join(fields, ["at", "key"], "left_anti").unionByName(fields.join(owed, ["at", "key"], "left_anti")), 13, "TARGET_FIELD_ALLOWLIST_MISMATCH", F.col("key")),
        checks.violations(denied, 14, "TARGET_DENY_SCOPE_INCOMPLETE", named()),
        entries_have(n, name, "minimum_target_projection.source_projections[]", ("denied_scope",), 14, "TARGET_DENY_SCOPE_INCOMPLETE"),
        *checks.exact_cover(wanted, audited, ["key"], 15, "TARGET_ACCESS_AUDITS_INCOMPLETE", "TARGET_ACCESS_AUDITS_INCOMPLETE"),
        equal(n, [(name, f"{a}.{k}", v) for a in audits for k, v in (("target_payload_decode_calls", 0), ("target_values_materialized", False))], 17, "TARGET_VALUE_ACCESS_DETECTED"),
        distinct(n, at(f"{cells}.physical_location_id", "temporal_eligibility_mapping[].physical_location_id"), 18, "TARGET_PAIR_DUPLICATE_LOCATION"),
        same(n, [(name, f"{cells}.physical_location_id", name, "temporal_eligibility_mapping[].physical_location_id")], 19, "TARGET_PAIR_LOCATION_MISMATCH"),
        entries_have(n, name, cells, ("physical_location_id", "prior.source_role", "current_2026.source_role"), 20, "TARGET_PAIR_COMPLETENESS_FAILED"),
        equal(n, all_are({f"{cells}.prior.source_role": roles[1], f"{cells}.current_2026.source_role": roles[0]}), 21, "TARGET_PAIR_SOURCE_ROLE_MISMATCH"),
        equal(n, all_are({"finalization.mandatory_reconciliations_passed": True, "finalization.target_values_accessed": False, "finalization.ready_marker_written_last": True, "minimum_target_projection.default_deny": True}), 22, "BINDING_FINALIZATION_CONFORMANCE_FAILED"),
    ]


def entries_have(n: DataFrame, document: str, path: str, fields: tuple[str, ...], order: int, code: str) -> DataFrame:
    """Elements of a list path that lack one of the fields, or have it null or empty."""
    mine = n.where(F.col("document") == document)
    owed = mine.where(F.col("path") == path).select("at", F.explode(F.array(*[F.lit(f"{path}.{f}") for f in fields])).alias("path"))
    have = mine.where("kind <> 'null' and value <> '\"\"'").select("at", "path")
    return checks.violations(owed.join(have, ["at", "path"], "left_anti"), order, code, F.concat_ws(":", F.lit(document), "path"), F.to_json("at"))


def handles_agree(n: DataFrame, order: int, code: str) -> DataFrame:
    """Projections whose workbook handle is not the one of their role's authority."""

    def by_role(top: str, handle: str) -> DataFrame:
        of = lambda field, name: n.where(F.col("path") == f"{top}.{field}").select("document", "at", F.col("value").alias(name))
        return of("source_role", "role").join(of("workbook_handle", handle), ["document", "at"], "left").select("document", "role", handle)

    j = by_role("minimum_target_projection.source_projections[]", "used").join(by_role("target_source_authorities[]", "granted"), ["document", "role"], "left")
    return checks.where_not(j, F.col("used") == F.col("granted"), order, code, F.concat_ws(":", "document", "role"))


def authority_rules(documents: DataFrame, *, preregistration: str, data: str, geography: list[str]) -> list[DataFrame]:
    """The preregistration depends on the data contract and on every geographic document, by id and digest."""
    n = nodes(documents.where(F.col("document").isin(preregistration, data, *geography)))
    bound = [("data", [data]), ("geo", geography)]
    found = []
    for order, (part, names) in enumerate(bound, 1):
        of = lambda field, path, where: n.where(where & (F.col("path") == path)).select("document", "at", F.col("value").alias(field))
        here, there = F.col("document").isin(*names), F.col("document") == preregistration
        stated = of("id", "artifact_id", here).join(of("sha", "content_sha256", here), ["document", "at"])
        listed = of("id", f"dependencies.{part}[].artifact_id", there).join(of("sha", f"dependencies.{part}[].content_sha256", there), ["document", "at"]).select("id", "sha")
        code = f"MODEL05_{part.upper()}_DEPENDENCY_MISMATCH"
        found += [present(n, [(d, f) for d in names for f in ("artifact_id", "content_sha256")], order, code), checks.violations(stated.join(listed, ["id", "sha"], "left_anti"), order, code, F.col("document"))]
    return found


# ---- reading and writing --------------------------------------------------------------------------------------------


def read_documents(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """document, body for each name and path; a path that is not there fails. Each file is one document."""
    parts = [spark.read.text(p, wholetext=True).select(F.lit(name).alias("document"), F.col("value").alias("body")) for name, p in paths.items()]
    return checks.union(parts)


def inventory_documents(inventory: DataFrame, expected: DataFrame, derivation: dict, version: str = "1.0.0", most: int = MOST_TRACTS) -> DataFrame:
    """document, body: one sealed inventory document for each market, its tract ids in order.

    inventory: market_id, tract_geoid; expected: market_id, expected (null or absent: no expectation). Each market is one
    document, so one of more than `most` tracts is an error, found before any list is built.
    """
    checks.require_none([
        checks.violations(inventory.groupBy("market_id").agg(F.count("*").alias("n")).where(F.col("n") > most), 1, "GEO04_INVENTORY_TOO_LARGE", F.col("market_id"), F.col("n")),
        checks.duplicates(inventory, ["market_id", "tract_geoid"], 2, "GEO04_DUPLICATE_CANONICAL_GEOID"),
    ])
    ordered = inventory.groupBy("market_id").agg(F.sort_array(F.collect_list("tract_geoid")).alias("ordered_geoids")).join(expected.select("market_id", F.col("expected").cast("long").alias("qa_expected_count")), "market_id", "left")
    count = F.size("ordered_geoids").cast("long")
    said = F.struct(
        F.concat(F.lit("inventory-"), "market_id").alias("artifact_id"), F.lit(version).alias("version"), F.struct(*[F.lit(v).alias(k) for k, v in derivation.items()]).alias("derivation_specification"),
        F.struct("market_id").alias("market_configuration"), "ordered_geoids", digest_column(F.col("ordered_geoids"), ordered).alias("inventory_sha256"), count.alias("tract_count"), "qa_expected_count", (count == F.col("qa_expected_count")).alias("qa_count_matches"),
    )
    made = ordered.select("market_id", said.alias("said"))
    whole = F.struct("said.*", digest_column(F.col("said"), made).alias("content_sha256"))
    return made.select(F.concat(F.lit("inventory-"), "market_id").alias("document"), canonical_column(whole, made).alias("body"))


def write_documents(documents: DataFrame, folder: str) -> None:
    """One text file under document=<name> for each document; a folder that is there already is an error."""
    documents.select("document", "body").repartition("document").write.mode("errorifexists").partitionBy("document").text(folder)
