import json

import pytest

from tractloom.functions.canonical import hexdigest, written
from tractloom.operators import authority, checks
from tractloom.operators import specifications as S

DERIVATION = {"artifact_id": "derivation", "content_sha256": "a" * 64}
IDS = {"m1": [f"5507900000{k}" for k in range(4)], "m2": ["55025000001"]}
CONTEXT, DISTANCE = "CTX_V1", "DIST_V1"


@pytest.fixture
def package(spark):
    inventory = spark.createDataFrame([(m, t) for m, ts in IDS.items() for t in ts], "market_id string, tract_geoid string")
    expected = spark.createDataFrame([(m, len(ts)) for m, ts in IDS.items()], "market_id string, expected int")
    inventories = authority.inventory_documents(inventory, expected, DERIVATION).cache()
    context = S.context_specification(inventories, DERIVATION, artifact_id=CONTEXT).cache()
    return {"inventories": inventories, "context": context, "membership": S.membership_specification(context, distance_id=DISTANCE).cache(), "markets": expected}


def spoilt(spark, docs, name, change, reseal=True):
    rows = []
    for r in docs.collect():
        body = json.loads(r.body)
        if r.document == name:
            change(body)
            if reseal:
                body["content_sha256"] = hexdigest({k: v for k, v in body.items() if k != "content_sha256"})
        rows.append((r.document, written(body)))
    return spark.createDataFrame(rows, "document string, body string").coalesce(1)


def rules(spark, p):
    counties = spark.createDataFrame([("m1", "55079"), ("m2", "55025")], "market_id string, county string")
    return [*S.inventory_rules(p["inventories"], DERIVATION, p["markets"], counties), *S.context_rules(p["context"], p["inventories"], DERIVATION, artifact_id=CONTEXT), *S.membership_rules(p["membership"], p["context"], distance_id=DISTANCE)]


def test_a_package_made_here_keeps_all_rules(spark, package):
    checks.require_none(rules(spark, package))
    said = json.loads(package["membership"].first().body)
    assert said["boundary_and_radius_binding"]["radii_m"] == [4828.032, 8046.72, 11265.408] and said["content_sha256"] == hexdigest({k: v for k, v in said.items() if k != "content_sha256"})
    listed = json.loads(package["context"].first().body)["canonical_geography"]["market_inventories"]
    assert [x["market_id"] for x in listed] == ["m1", "m2"] and listed[0]["inventory_sha256"] == hexdigest(IDS["m1"])


def put(*path_and_value):
    *path, last, value = path_and_value

    def change(body):
        for k in path:
            body = body[k]
        body[last] = value

    return change


def turned(body):
    body["ordered_geoids"] = body["ordered_geoids"][::-1]
    body["inventory_sha256"] = hexdigest(body["ordered_geoids"])


FAULTS = [
    ("inventories", "inventory-m1", put("version", "2"), "GEO04_INVENTORY_IDENTITY_MISMATCH", True), ("inventories", "inventory-m1", put("version", "2"), "GEO04_CONTENT_HASH_MISMATCH", False),
    ("inventories", "inventory-m1", put("market_configuration", "market_id", "m9"), "GEO04_MARKET_UNKNOWN", True), ("inventories", "inventory-m2", put("derivation_specification", "content_sha256", "b"), "GEO04_DERIVATION_LINEAGE_MISMATCH", True),
    ("inventories", "inventory-m1", turned, "GEO04_INVENTORY_ORDER_MISMATCH", True), ("inventories", "inventory-m1", put("ordered_geoids", 0, "5507"), "GEO04_GEOID_INVALID", True), ("inventories", "inventory-m1", put("ordered_geoids", 1, IDS["m1"][0]), "GEO04_DUPLICATE_CANONICAL_GEOID", True),
    ("inventories", "inventory-m2", put("ordered_geoids", 0, "55026000001"), "GEO04_COUNTY_RECONCILIATION_FAILED", True), ("inventories", "inventory-m2", put("inventory_sha256", "c" * 64), "GEO04_INVENTORY_HASH_MISMATCH", True), ("inventories", "inventory-m2", put("tract_count", 2), "GEO04_INVENTORY_COUNT_MISMATCH", True),
    ("context", "context", put("artifact_id", "X"), "GEO02_CONTEXT_VERSION_MISMATCH", True), ("context", "context", put("canonical_geography", "inventory_derivation", "content_sha256", "b"), "GEO02_CONTEXT_DERIVATION_MISMATCH", True), ("context", "context", put("canonical_geography", "market_inventories", []), "GEO02_CONTEXT_INVENTORY_MISMATCH", True),
    ("context", "context", put("context_family_semantics", "zero_area_tangency", "kept"), "GEO02_CONTEXT_SEMANTICS_MISMATCH", True), ("context", "context", put("projected_context_space", "EPSG:4326"), "GEO02_CONTEXT_PARAMETER_OWNERSHIP_MISMATCH", True),
    ("membership", "membership", put("transformation", "operation", "target_crs", "x"), "GEO03_OPERATION_SEMANTICS_MISMATCH", True), ("membership", "membership", put("transformation", "operation", "projection", "false_easting_m", 1.0), "GEO03_OPERATION_FINGERPRINT_MISMATCH", True),
    ("membership", "membership", put("boundary_and_radius_binding", "radii_m", [1.0]), "GEO03_MEMBERSHIP_BOUNDARY_MISMATCH", True), ("membership", "membership", put("validation_membership_distance", "unit", "mile"), "GEO03_DISTANCE_SEMANTICS_MISMATCH", True),
    ("membership", "membership", put("geo02_lineage", "subordinate_to_context_specification", "content_sha256", "d"), "GEO03_CONTEXT_LINEAGE_MISMATCH", True), ("membership", "membership", put("membership_jaccard_rule", "x"), "GEO03_COMPETING_JACCARD", True),
]


@pytest.mark.parametrize("part", ["inventories", "context", "membership"])
def test_each_fault_is_reported(spark, package, part):
    for where, name, change, code, reseal in FAULTS:
        if where == part:
            p = package | {part: spoilt(spark, package[part], name, change, reseal)}
            own = {"inventories": lambda q: S.inventory_rules(q["inventories"], DERIVATION, q["markets"], spark.createDataFrame([("m1", "55079"), ("m2", "55025")], "market_id string, county string")), "context": lambda q: S.context_rules(q["context"], q["inventories"], DERIVATION, artifact_id=CONTEXT), "membership": lambda q: S.membership_rules(q["membership"], q["context"], distance_id=DISTANCE)}[part]
            found = {r.code for r in checks.union(own(p)).collect()}
            assert code in found, (code, found)
