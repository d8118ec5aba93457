import copy
import json

import pytest

from tractloom import publish
from tractloom.functions.canonical import hexdigest, written
from tractloom.operators import authority, checks
from tractloom.operators.checks import ConformanceError
from tractloom.sources import handles


def table(spark, **documents):
    return spark.createDataFrame([(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in documents.items()], "document string, body string")


def codes(found):
    return {r.code for r in checks.union(found).collect()}


def seal(document, field="content_sha256"):
    return document | {field: hexdigest({k: v for k, v in document.items() if k != field})}


def test_nodes(spark):
    n = authority.nodes(table(spark, a={"x": [{"y": 1}, {"y": None}]}, broken="{", nothing=None, scalar="3"))
    got = {(r.document, r.path, tuple(r.at), r.kind, r.value) for r in n.collect()}
    assert ("a", "x[].y", (0,), "number", "1") in got and ("a", "x[].y", (1,), "null", "null") in got and ("a", "x", (), "array", '[{"y":1},{"y":null}]') in got
    assert {r[3] for r in got if r[0] == "broken"} == {"unreadable"} and not [r for r in got if r[0] == "nothing"] and ("scalar", "", (), "number", "3") in got
    assert authority.nodes(table(spark, deep="[" * 100_000)).first().kind == "unreadable"


def test_rules(spark):
    docs = table(spark, a={"id": "p", "list": [1, 2, 2], "sha": hexdigest({"k": 1}), "of": {"k": 1}, "none": None, "blank": ""}, b={"id": "p", "list": [2, 1], "more": [1, 2, 3]})
    n = authority.nodes(docs)
    keys = lambda df: sorted(r.key for r in df.collect())
    assert keys(authority.present(n, [("a", "id"), ("a", "none"), ("a", "blank"), ("c", "id")], 1, "P")) == ["a:blank", "a:none", "c:id"]
    assert keys(authority.equal(n, [("a", "id", "p"), ("b", "id", "q"), ("a", "gone", 1), ("a", "of", {"k": 1})], 1, "E")) == ["a:gone", "b:id"]
    assert keys(authority.distinct(n, [("a", "list[]"), ("b", "list[]")], 1, "D")) == ["a/list[]/2"]
    assert not keys(authority.same(n, [("a", "list[]", "b", "list[]"), ("a", "id", "b", "id")], 1, "S"))
    assert keys(authority.same(n, [("a", "list[]", "b", "more[]"), ("a", "gone", "b", "gone")], 1, "S")) == ["a:gone:b:gone", "a:list[]:b:more[]"]
    assert not keys(authority.same(n, [("a", "list[]", "b", "more[]")], 1, "S", both=False))
    assert not keys(authority.digests(n, [("a", "of", "a", "sha")], 1, "H")) and keys(authority.digests(n, [("a", "list", "a", "sha")], 1, "H"))
    assert keys(authority.exact_fields(n, "b", "", ("id", "list", "lost"), 1, "F")) == ["b::lost", "b::more"]


def contract():
    manifest = lambda i: seal({f: "x" for f in authority.MANIFEST_FIELDS} | {"manifest_id": i, "manifest_version": "1.0.0", "accepted_vintage": "2024", "checksum_algorithm": "SHA-256", "acquisition_state": "acquired"}, "manifest_content_sha256")
    sources = [{"family": "Tracts", "source_manifest_id": "m1"}, {"family": "Households", "source_manifest_id": "m2"}]
    return {"data": seal({f: "x" for f in authority.CONTRACT_FIELDS} | {"version": "1.0.0", "hash_algorithm": "SHA-256", "accepted_sources": sources}), "tracts": manifest("m1"), "households": manifest("m2")}


def test_data_contract(spark):
    def check(change=lambda d: None, resealed=True):
        docs = copy.deepcopy(contract())
        change(docs)
        if resealed:
            docs = {k: seal(v, "content_sha256" if k == "data" else "manifest_content_sha256") for k, v in docs.items()}
        return codes(authority.contract_rules(table(spark, **docs), "data", {"tracts": "Tracts", "households": "Households"}))

    assert check() == set()
    assert check(lambda d: d["tracts"].pop("lineage")) == {"DATA_MANIFEST_INCOMPLETE"}
    assert check(lambda d: d["tracts"].update(source_reference="the LATEST release")) == {"DATA_MOVING_IDENTITY_REJECTED"}
    assert check(lambda d: d["data"].update(purpose="other"), resealed=False) == {"CONTENT_HASH_MISMATCH"}
    assert check(lambda d: d["households"].update(acquisition_state="pending")) == {"DATA_MANIFEST_STATE_MISMATCH"}
    swapped = lambda d: d["data"]["accepted_sources"][0].update(family="Households") or d["data"]["accepted_sources"][1].update(family="Tracts")
    assert check(swapped) == {"DATA_CONFIG_SOURCES_INVALID"}


def preregistered():
    top = {}
    for path, value in authority.PREREGISTERED.items():
        first, second = path.split(".")
        top.setdefault(first, {})[second] = value
    return seal(top | {"artifact_id": "p", "version": "1.0.0", "canonical_schema_version": "1", "dependencies": {"data": [{"artifact_id": "d", "content_sha256": "aa"}], "geo": [{"artifact_id": "g", "content_sha256": "bb"}]}, "supersedes": None})


def test_preregistration_and_authorities(spark):
    right = preregistered()
    assert codes(authority.preregistration_rules(table(spark, p=right), "p")) == set()
    moved = copy.deepcopy(right)
    moved["dependence"]["stress_grouping_jaccard_threshold"] = 0.3
    assert codes(authority.preregistration_rules(table(spark, p=seal(moved)), "p")) == {"MODEL05_FROZEN_VALUE_MISMATCH"}
    assert codes(authority.preregistration_rules(table(spark, p=seal({k: v for k, v in right.items() if k != "supersedes"})), "p")) == {"MODEL05_PREREGISTRATION_SCHEMA_INVALID"}
    bound = lambda sha: codes(authority.authority_rules(table(spark, p=right, d={"artifact_id": "d", "content_sha256": "aa"}, g={"artifact_id": "g", "content_sha256": sha}), preregistration="p", data="d", geography=["g"]))
    assert bound("bb") == set() and bound("cc") == {"MODEL05_GEO_DEPENDENCY_MISMATCH"}


def package():
    now, before = authority.SOURCE_ROLES
    authorities = [{"source_role": r, "workbook_handle": f"phandle-{r}", "authority_id": "a", "provenance_class": "c", "whole_workbook_hash_computed": False} for r in (now, before)]
    projections = [{"source_role": r, "workbook_handle": f"phandle-{r}", "allowed_fields": ["x", "y"], "denied_scope": ["rest"]} for r in (now, before)]
    cells = [{"physical_location_id": i, "prior": {"source_role": before}, "current_2026": {"source_role": now}} for i in ("l1", "l2")]
    audits = {r: {"target_payload_decode_calls": 0, "target_values_materialized": False} for r in (now, before)}
    return {f: "x" for f in authority.PACKAGE_FIELDS} | {
        "version": "2.0.0", "state": "ready", "model_authority": {"commitment_reconciled": True}, "pipe01_authority": {"upstream_frozen_artifacts_regenerated": False}, "target_source_authorities": authorities,
        "temporal_eligibility_mapping": [{"physical_location_id": i} for i in ("l2", "l1")],
        "minimum_target_projection": {"default_deny": True, "target_cells": cells, "source_projections": projections, "target_access_audits": audits},
        "finalization": {"mandatory_reconciliations_passed": True, "target_values_accessed": False, "ready_marker_written_last": True},
    }


@pytest.mark.parametrize(
    ("change", "code"),
    [
        (lambda p: None, None),
        (lambda p: p.pop("supersedes"), "BINDING_PACKAGE_SCHEMA_INVALID"),
        (lambda p: p.update(extra=1), "BINDING_PACKAGE_SCHEMA_INVALID"),
        (lambda p: p.update(version="1.0.0"), "BINDING_IDENTITY_MISMATCH"),
        (lambda p: p["target_source_authorities"].pop(), "TARGET_SOURCE_ROLES_INCOMPLETE"),
        (lambda p: p["target_source_authorities"][0].pop("authority_id"), "TARGET_SOURCE_AUTHORITY_UNRESOLVED"),
        (lambda p: p["minimum_target_projection"]["source_projections"][0].update(workbook_handle="phandle-other"), "TARGET_SOURCE_HANDLE_MISMATCH"),
        (lambda p: p["minimum_target_projection"]["source_projections"][0]["allowed_fields"].append("z"), "TARGET_FIELD_ALLOWLIST_MISMATCH"),
        (lambda p: p["minimum_target_projection"]["source_projections"][1].update(denied_scope=[]), "TARGET_DENY_SCOPE_INCOMPLETE"),
        (lambda p: p["minimum_target_projection"]["target_access_audits"].popitem(), "TARGET_ACCESS_AUDITS_INCOMPLETE"),
        (lambda p: p["minimum_target_projection"]["target_cells"].append(p["minimum_target_projection"]["target_cells"][0]), "TARGET_PAIR_DUPLICATE_LOCATION"),
        (lambda p: p["minimum_target_projection"]["target_cells"].pop(), "TARGET_PAIR_LOCATION_MISMATCH"),
        (lambda p: p["minimum_target_projection"]["target_cells"][0]["prior"].update(source_role="x"), "TARGET_PAIR_SOURCE_ROLE_MISMATCH"),
        (lambda p: p["finalization"].update(target_values_accessed=True), "BINDING_FINALIZATION_CONFORMANCE_FAILED"),
    ],
)
def test_binding_package(spark, change, code):
    p = package()
    change(p)
    rules = authority.package_rules(table(spark, b=p), "b", {"version": "2.0.0"}, ("x", "y"))
    if code is None:
        checks.require_none(rules)
    else:
        assert code in codes(rules)


def test_inventory_documents(spark, tmp_path):
    rows = spark.createDataFrame([("m", "2"), ("m", "1"), ("n", "3")], "market_id string, tract_geoid string")
    expected = spark.createDataFrame([("m", 3)], "market_id string, expected long")
    docs = authority.inventory_documents(rows, expected, {"artifact_id": "d"})
    body = {r.document: json.loads(r.body) for r in docs.collect()}
    assert body["inventory-m"]["ordered_geoids"] == ["1", "2"] and body["inventory-m"]["qa_count_matches"] is False and body["inventory-n"]["qa_count_matches"] is None
    assert body["inventory-m"]["inventory_sha256"] == hexdigest(["1", "2"]) and body["inventory-m"] == seal(body["inventory-m"])
    authority.write_documents(docs, str(tmp_path / "docs"))
    again = spark.read.text(str(tmp_path / "docs"))
    assert {r.value for r in again.collect()} == {written(b) for b in body.values()}
    with pytest.raises(Exception, match="(?i)exists"):
        authority.write_documents(docs, str(tmp_path / "docs"))
    with pytest.raises(ConformanceError, match="TOO_LARGE"):
        authority.inventory_documents(rows, expected, {}, most=1)
    with pytest.raises(ConformanceError, match="DUPLICATE"):
        authority.inventory_documents(rows.unionByName(rows), expected, {})
    read = authority.read_documents(spark, {r.document: f"{tmp_path}/docs/document={r.document}" for r in docs.collect()})
    assert codes([authority.sealed(read, "content_sha256", 1, "X")]) == set()


def test_handles(spark, tmp_path):
    (tmp_path / "f.txt").write_text("x")
    roots = spark.createDataFrame([("proot-a", str(tmp_path))], "root_handle string, root_path string")
    paths = {"phandle-ok": "f.txt", "phandle-gone": "g.txt", "phandle-up": "../f.txt", "phandle-glob": "*.txt", "phandle-abs": "/etc/passwd", "phandle-scheme": "s3:x", "phandle-blank": "", "phandle-null": None}
    resources = spark.createDataFrame([(h, "file", "proot-a", p) for h, p in paths.items()], "handle string, kind string, root_handle string, relative_path string")
    assert handles.path_of(spark, "phandle-ok", "file", resources, roots) == f"{tmp_path}/f.txt"
    for handle, code in [("phandle-gone", "FILE_UNRESOLVED"), ("phandle-blank", "RELATIVE_PATH"), ("phandle-null", "RELATIVE_PATH"), ("phandle-none", "HANDLE_UNRESOLVED"), ("other", "HANDLE_INVALID"), *[(f"phandle-{x}", "TRAVERSAL") for x in ("up", "glob", "abs", "scheme")]]:
        with pytest.raises(ConformanceError, match=code):
            handles.path_of(spark, handle, "file", resources, roots)
    with pytest.raises(ConformanceError, match="KIND"):
        handles.path_of(spark, "phandle-ok", "table", resources, roots)


def test_registry(spark):
    roots = lambda *rows: spark.createDataFrame(rows, "root_handle string, root_path string")
    bad = roots(("a", "/x"), ("proot-b", "x/y"), ("proot-c", "/repo/data"), ("proot-d", "/x/../repo"), ("proot-e", "/repository"), ("proot-e", "file:///repo"))
    found = {(r.code.removeprefix("PROTECTED_ROOT_"), r.key) for r in checks.union(handles.root_violations(bad, "/repo")).collect()}
    assert found == {("HANDLE_INVALID", "a"), ("PATH_INVALID", "proot-b"), ("INSIDE_REPOSITORY", "proot-c"), ("PATH_INVALID", "proot-d"), ("INSIDE_REPOSITORY", "proot-e"), ("HANDLE_INVALID", "proot-e")}
    pairs = lambda *rows: spark.createDataFrame(rows, "source_role string, workbook_handle string")
    right = pairs(("now", "phandle-1"), ("before", "phandle-2"))
    assert codes(handles.authority_violations(right, right, ("now", "before"))) == set()
    swapped = pairs(("now", "phandle-2"), ("before", "phandle-1"))
    assert codes(handles.authority_violations(right, swapped, ("now", "before"))) == {"TARGET_SOURCE_HANDLE_MISMATCH"}
    assert "TARGET_SOURCE_HANDLE_REUSED" in codes(handles.authority_violations(pairs(("now", "phandle-1"), ("before", "phandle-1")), right, ("now", "before")))


def test_supersession(spark, tmp_path):
    first, tables = str(tmp_path / "first"), {"t": spark.range(3)}
    again = lambda name, **how: publish.publish(spark, str(tmp_path / name), tables, [], dependencies={}, **how)
    with pytest.raises(ConformanceError, match="RUN_NOT_FROZEN"):
        again("second", version="1.1.0", supersedes=first)
    again("first")
    with pytest.raises(ConformanceError, match="NEW_VERSION"):
        again("second", supersedes=first)
    again("second", version="1.1.0", supersedes=first)
    assert publish.reconcile(spark, str(tmp_path / "second"))["supersedes"] == first


def test_documents_are_read_once(spark):
    """Of the rules of document_violations only the seal reads the documents again; nodes are dealt out once for the others."""
    from tractloom.plans import catalog

    plan = catalog.QUERIES["document_violations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
