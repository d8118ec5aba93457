"""Specification documents of a market's geography, and the rules they are held to.

Inventories (one for each market, `authority.inventory_documents`), a context specification that names them all, and a
membership specification under that context. Each is a row (document, body) of canonical text with the digest of its rest, made
by columns from the rows of the one before it. The rules read documents as nodes: inventories are checked all at once, by joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.functions.canonical import canonical_column, digest_column
from tractloom.operators import authority, checks
from tractloom.operators.membership import MEMBERSHIP_SPEC, RADII_M

# What the specifications must state.
SOURCE_CRS, TARGET_CRS, AXES = "EPSG:4269", "EPSG:5070", ("longitude", "latitude")
INTERSECTION, TANGENCY, JACCARD = "positive-area", "excluded from membership", "controlling Jaccard measure"
COMPARISON, OWNER, UNIT = "distance_m <= radius_m", "MODEL", "metre"
PROJECTION = {"method": "EPSG:9822", "latitude_of_false_origin": 23.0, "longitude_of_false_origin": -96.0, "first_standard_parallel": 29.5, "second_standard_parallel": 45.5, "false_easting_m": 0.0, "false_northing_m": 0.0}
MOST_MARKETS = 100_000  # of one context specification


def stated(**fields) -> Column:
    """A struct of literals, columns, and structs and lists of these."""

    def of(v) -> Column:
        if isinstance(v, Column):
            return v
        if isinstance(v, dict):
            return stated(**v)
        if isinstance(v, (list, tuple)):
            return F.array(*map(of, v))
        return F.lit(v)

    return F.struct(*[of(v).alias(k) for k, v in fields.items()])


def sealed_document(rows: DataFrame, name: str, said: Column) -> DataFrame:
    """document, body: the text of a struct and its own digest. One row with many fields, so its text is written by the Arrow
    function; compiled, each number would be an expression of its own."""
    made = rows.select(said.alias("said"))
    return made.select(F.lit(name).alias("document"), canonical_column(F.struct("said.*", digest_column(F.col("said")).alias("content_sha256"))).alias("body"))


def field(path: str) -> Column:
    return F.get_json_object("body", f"$.{path}")


def context_specification(inventories: DataFrame, derivation: dict, *, artifact_id: str, version: str = "1.0.0", name: str = "context") -> DataFrame:
    """One document over all inventory documents (document, body), in order of their markets.

    derivation: artifact_id and content_sha256 of how inventories are derived. It names every market, so more than MOST_MARKETS are an error.
    """
    checks.require_none([checks.violations(inventories.agg(F.count("*").alias("n")).where(F.col("n") > MOST_MARKETS), 1, "GEO02_CONTEXT_INVENTORY_MISMATCH", F.lit(name), F.col("n"))])
    of_market = F.struct(field("market_configuration.market_id").alias("market_id"), *[field(c).alias(c) for c in ("artifact_id", "version", "content_sha256", "inventory_sha256")])
    listed = inventories.agg(F.sort_array(F.collect_list(of_market)).alias("market_inventories"))
    said = stated(
        artifact_id=artifact_id, version=version, projected_context_space=TARGET_CRS, supersedes=F.lit(None).cast("string"),
        canonical_geography={"inventory_derivation": {k: derivation[k] for k in ("artifact_id", "content_sha256")}, "market_inventories": F.col("market_inventories")},
        context_family_semantics={"radius_parameter_owner": OWNER, "tract_intersection": INTERSECTION, "zero_area_tangency": TANGENCY, "geometric_jaccard": JACCARD},
    )
    return sealed_document(listed, name, said)


def operation() -> tuple[Column, Column]:
    """The projection as a struct, and its fingerprint."""
    said = stated(source_crs=SOURCE_CRS, target_crs=TARGET_CRS, logical_input_axis_order=AXES, projection=PROJECTION)
    return said, digest_column(said)


def membership_specification(context: DataFrame, *, distance_id: str, artifact_id: str = MEMBERSHIP_SPEC, version: str = "1.0.0", radii: tuple[float, ...] = RADII_M, name: str = "membership") -> DataFrame:
    """The document under a context specification (one row document, body)."""
    op, fingerprint = operation()
    said = stated(
        artifact_id=artifact_id, version=version, supersedes=F.lit(None).cast("string"), transformation={"operation": op, "operation_fingerprint_sha256": fingerprint},
        validation_membership_distance={"artifact_id": distance_id, "unit": UNIT}, boundary_and_radius_binding={"comparison": COMPARISON, "epsilon_or_snap_or_rounding_permitted": False, "owner": OWNER, "radii_m": radii},
        geo02_lineage={"subordinate_to_context_specification": {c: field(c) for c in ("artifact_id", "version", "content_sha256")}},
    )
    return sealed_document(context, name, said)


def inventory_rules(inventories: DataFrame, derivation: dict, markets: DataFrame, counties: DataFrame | None = None, version: str = "1.0.0") -> list[DataFrame]:
    """Rules of all inventory documents at once, in the order they are reported.

    markets: market_id and expected, its accepted number of tracts; counties: market_id and county (five digits), without it counties
    are not checked. A document's market decides what it is held to. Lists are compared position by position.
    """
    n = authority.nodes(inventories)
    scalar = lambda path, name: n.where(F.col("path") == path).select("document", F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v").alias(name))
    docs = inventories.select("document")
    for path, name in (("market_configuration.market_id", "market_id"), ("artifact_id", "artifact_id"), ("version", "version"), ("derivation_specification.artifact_id", "derived"), ("derivation_specification.content_sha256", "derived_sha"), ("inventory_sha256", "stated_sha"), ("tract_count", "tract_count"), ("qa_count_matches", "qa")):
        docs = docs.join(scalar(path, name), "document", "left")
    docs = docs.join(markets.select("market_id", "expected", F.lit(True).alias("known")), "market_id", "left")
    key = F.col("document")
    held = lambda condition, order, code: checks.where_not(docs, condition, order, code, key)
    geoids = n.where("path = 'ordered_geoids[]'").select("document", F.element_at("at", 1).alias("i"), F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v").alias("geoid"), "kind")
    after = geoids.select("document", (F.col("i") - 1).alias("i"), F.col("geoid").alias("next"))
    counted = docs.join(geoids.groupBy("document").agg(F.count("*").alias("n")), "document", "left")
    listed = n.where("path = 'ordered_geoids' and kind = 'array'").select("document", F.sha2("value", 256).alias("made_sha"))
    found = [
        authority.readable(n, 1, "JSON_OBJECT_REQUIRED"),
        authority.sealed(inventories, "content_sha256", 2, "GEO04_CONTENT_HASH_MISMATCH"),
        held(F.col("known"), 3, "GEO04_MARKET_UNKNOWN"),
        held((F.col("artifact_id") == F.concat(F.lit("inventory-"), "market_id")) & (F.col("version") == version), 4, "GEO04_INVENTORY_IDENTITY_MISMATCH"),
        held((F.col("derived") == derivation["artifact_id"]) & (F.col("derived_sha") == derivation["content_sha256"]), 5, "GEO04_DERIVATION_LINEAGE_MISMATCH"),
        checks.violations(geoids.join(after, ["document", "i"]).where("geoid > next"), 7, "GEO04_INVENTORY_ORDER_MISMATCH", key, F.col("i")),
        checks.where_not(geoids, (F.col("kind") == "string") & F.col("geoid").rlike(r"\A[0-9]{11}\z"), 8, "GEO04_GEOID_INVALID", key),
        checks.duplicates(geoids, ["document", "geoid"], 9, "GEO04_DUPLICATE_CANONICAL_GEOID"),
        checks.where_not(docs.join(listed, "document", "left"), F.col("made_sha") == F.col("stated_sha"), 11, "GEO04_INVENTORY_HASH_MISMATCH", key),
        checks.where_not(counted, (F.col("tract_count").cast("bigint") == F.coalesce("n", F.lit(0))) & (F.col("n") == F.col("expected")) & (F.col("qa") == "true"), 12, "GEO04_INVENTORY_COUNT_MISMATCH", key),
    ]
    if counties is not None:
        allowed = counties.select("market_id", F.col("county"))
        outside = geoids.join(docs.select("document", "market_id"), "document").withColumn("county", F.substring("geoid", 1, 5)).join(allowed, ["market_id", "county"], "left_anti")
        found.append(checks.violations(outside, 10, "GEO04_COUNTY_RECONCILIATION_FAILED", key, F.col("geoid")))
    return found


def context_rules(context: DataFrame, inventories: DataFrame, derivation: dict, *, artifact_id: str, version: str = "1.0.0", name: str = "context") -> list[DataFrame]:
    """Rules of a context specification over its inventories."""
    n = authority.nodes(context)
    listed = lambda c: n.where(F.col("path") == f"canonical_geography.market_inventories[].{c}").select("at", F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v").alias(c))
    fields = ("market_id", "content_sha256", "inventory_sha256")
    named = listed(fields[0]).join(listed(fields[1]), "at", "full").join(listed(fields[2]), "at", "full").select(*fields)
    owed = inventories.select(field("market_configuration.market_id").alias("market_id"), field("content_sha256").alias("content_sha256"), field("inventory_sha256").alias("inventory_sha256"))
    semantics = "context_family_semantics"
    wrong = [checks.violations(a.join(b, list(fields), "left_anti"), 4, "GEO02_CONTEXT_INVENTORY_MISMATCH", F.coalesce("market_id", F.lit(name))) for a, b in ((named, owed), (owed, named))]
    return [
        authority.sealed(context, "content_sha256", 1, "GEO02_CONTENT_HASH_MISMATCH"),
        authority.equal(n, [(name, "artifact_id", artifact_id), (name, "version", version)], 2, "GEO02_CONTEXT_VERSION_MISMATCH"),
        authority.equal(n, [(name, "canonical_geography.inventory_derivation.content_sha256", derivation["content_sha256"])], 3, "GEO02_CONTEXT_DERIVATION_MISMATCH"),
        *wrong,
        authority.equal(n, [(name, f"{semantics}.{c}", v) for c, v in (("tract_intersection", INTERSECTION), ("zero_area_tangency", TANGENCY), ("geometric_jaccard", JACCARD))], 5, "GEO02_CONTEXT_SEMANTICS_MISMATCH"),
        authority.equal(n, [(name, "projected_context_space", TARGET_CRS), (name, f"{semantics}.radius_parameter_owner", OWNER)], 6, "GEO02_CONTEXT_PARAMETER_OWNERSHIP_MISMATCH"),
    ]


def membership_rules(membership: DataFrame, context: DataFrame, *, distance_id: str, artifact_id: str = MEMBERSHIP_SPEC, version: str = "1.0.0", radii: tuple[float, ...] = RADII_M, name: str = "membership") -> list[DataFrame]:
    """Rules of a membership specification under its context."""
    both = membership.unionByName(context.withColumn("document", F.lit("__context")))
    n = authority.nodes(both)
    at = lambda part, **values: [(name, f"{part}.{c}", v) for c, v in values.items()]
    parent = "geo02_lineage.subordinate_to_context_specification"
    own = n.where(F.col("document") == name)
    second = own.where(F.lower(F.coalesce("key", F.lit(""))).contains("membership_jaccard") | ((F.col("kind") == "string") & F.lower("value").contains("membership_jaccard")))
    return [
        authority.sealed(membership, "content_sha256", 1, "GEO03_CONTENT_HASH_MISMATCH"),
        authority.equal(n, [(name, "artifact_id", artifact_id), (name, "version", version)], 2, "GEO03_MEMBERSHIP_VERSION_MISMATCH"),
        authority.equal(n, at("transformation.operation", source_crs=SOURCE_CRS, target_crs=TARGET_CRS, logical_input_axis_order=list(AXES)), 3, "GEO03_OPERATION_SEMANTICS_MISMATCH"),
        authority.digests(n, [(name, "transformation.operation", name, "transformation.operation_fingerprint_sha256")], 4, "GEO03_OPERATION_FINGERPRINT_MISMATCH"),
        authority.equal(n, at("boundary_and_radius_binding", comparison=COMPARISON, epsilon_or_snap_or_rounding_permitted=False, owner=OWNER, radii_m=list(radii)), 5, "GEO03_MEMBERSHIP_BOUNDARY_MISMATCH"),
        authority.equal(n, at("validation_membership_distance", artifact_id=distance_id, unit=UNIT), 6, "GEO03_DISTANCE_SEMANTICS_MISMATCH"),
        authority.same(n, [(name, f"{parent}.{c}", "__context", c) for c in ("artifact_id", "content_sha256")], 7, "GEO03_CONTEXT_LINEAGE_MISMATCH"),
        checks.violations(second, 8, "GEO03_COMPETING_JACCARD", F.col("document"), F.col("path")),
    ]
