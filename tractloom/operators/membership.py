"""Inventory, internal points, radius membership and household opportunity: one plan over all contexts of all markets.

Membership keeps every tract of the context's market at every radius, members or not, with three-valued logic: an
unknown distance stays unknown, except that the anchor tract is always a member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractloom.functions.coordinates import albers, parsed_point, planar_distance_m
from tractloom.functions.households import STATUSES
from tractloom.operators import checks
from tractloom.operators.cells import around, within

# Radii of 3, 5 and 7 miles in metres and the thresholds of eligibility.
RADII_M = (4828.032, 8046.72, 11265.408)
PRIMARY_RADIUS_M = 8046.72
PRIMARY_COMPLETENESS, SECONDARY_COMPLETENESS, JACCARD_STRESS = 0.90, 0.75, 0.25
MEMBERSHIP_SPEC = "GEO03_EPSG5070_PLANAR_ANCHOR_TO_TRACT_INTPT_M_V1"


def derive_inventory(tracts: DataFrame, counties: list[tuple[str, str]]) -> tuple[DataFrame, list[DataFrame]]:
    """(market_id, tract_geoid) of the tracts in each market's counties, and the violations of the source.

    tracts: STATEFP, COUNTYFP, TRACTCE, GEOID; counties: (market_id, five-digit county).
    """
    widths = {"STATEFP": 2, "COUNTYFP": 3, "TRACTCE": 6, "GEOID": 11}
    key = F.col("GEOID")
    well = [checks.where_not(tracts, F.trim(c).rlike(rf"\A[0-9]{{{n}}}\z"), 10, "GEO04_SOURCE_COMPONENT_INVALID", key, c) for c, n in widths.items()]
    states = sorted({c[:2] for _, c in counties})
    wanted = tracts.sparkSession.createDataFrame(counties, "market_id string, county string")
    named = tracts.withColumn("county", F.concat("STATEFP", "COUNTYFP"))
    chosen = named.join(F.broadcast(wanted), "county")  # the configured counties: a short list
    found = [
        *well,
        checks.where_not(tracts, F.col("STATEFP").isin(states), 20, "GEO04_STATEFP_MISMATCH", key),
        checks.where_not(tracts, key == F.concat("STATEFP", "COUNTYFP", "TRACTCE"), 30, "GEO04_GEOID_COMPONENT_MISMATCH", key),
        checks.duplicates(tracts, ["GEOID"], 40, "GEO04_DUPLICATE_CANONICAL_GEOID"),
        checks.not_covered(wanted, named, ["county"], 50, "GEO04_COUNTY_RECONCILIATION_FAILED"),
    ]
    return chosen.select("market_id", F.col("GEOID").alias("tract_geoid")), found


def inventory(tracts: DataFrame) -> DataFrame:
    """tracts (market_id, tract_geoid) with ordinal_position, 1-based in GEOID order within the market.

    The order is one window per market. Ranks within ranges of GEOIDs and range offsets are used instead of one sort of
    a whole market: a tract's position is the rows of lower prefixes plus its rank within its prefix.
    """
    cut = F.substring("tract_geoid", 1, 8)
    t = tracts.withColumn("__p", cut)
    sizes = t.groupBy("market_id", "__p").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("market_id").orderBy("__p")) - F.col("n")).drop("n")
    ranked = t.withColumn("__r", F.row_number().over(Window.partitionBy("market_id", "__p").orderBy("tract_geoid")))
    return ranked.join(before, ["market_id", "__p"]).withColumn("ordinal_position", (F.col("before") + F.col("__r")).cast("int")).drop("__p", "__r", "before")


def inventory_violations(tracts: DataFrame) -> list[DataFrame]:
    return [
        checks.where_not(tracts, F.length("market_id") > 0, 10, "MARKET_ID_MISSING", F.col("tract_geoid")),
        checks.where_not(tracts, F.col("tract_geoid").rlike(r"\A[0-9]{11}\z"), 20, "GEOID_INVALID", F.col("tract_geoid")),
        checks.duplicates(tracts, ["market_id", "tract_geoid"], 30, "DUPLICATE_GEOID"),
    ]


def internal_points(points: DataFrame, latitude: str = "INTPTLAT", longitude: str = "INTPTLON", project=albers) -> DataFrame:
    """points with coordinate_state, parsed values, transformation_state and projected metres.

    project: (longitude, latitude) columns to a struct (x, y), null where it cannot say.
    """
    p = points.withColumn("__p", parsed_point(F.col(latitude), F.col(longitude)))
    xy = F.when(F.col("__p.state") == "valid", project(F.col("__p.longitude"), F.col("__p.latitude")))
    p = p.withColumn("__xy", xy)
    return p.select(
        *points.columns, F.col("__p.latitude").alias("parsed_latitude"), F.col("__p.longitude").alias("parsed_longitude"), F.col("__p.state").alias("coordinate_state"),
        F.when(F.col("__xy").isNotNull(), "transformed").otherwise("noncomputable").alias("transformation_state"), F.col("__xy.x").alias("projected_x_m"), F.col("__xy.y").alias("projected_y_m"),
    )


def reason_code(ordinary: Column, forced: Column, computable: Column) -> Column:
    return (
        F.when(forced & ~computable, "valid_anchor_forced_inclusion_internal_point_gap")
        .when(forced, "valid_anchor_forced_inclusion_outside_radius")
        .when(ordinary, "ordinary_radius_membership")
        .when(~ordinary, "ordinary_outside_radius")
        .otherwise("nonanchor_membership_noncomputable")
    )


def membership(contexts: DataFrame, points: DataFrame, radii: tuple[float, ...] = RADII_M) -> DataFrame:
    """A row for each context, radius and tract of its market.

    contexts: market_id, context_spec_id, context_instance_id, anchor_tract_geoid, anchor_x_m, anchor_y_m.
    points: market_id, tract_geoid, projected_x_m, projected_y_m. Both sides meet on market_id; radii are exploded from
    a literal after the join, so it is done once.
    """
    joined = contexts.join(points.select("market_id", "tract_geoid", "projected_x_m", "projected_y_m"), "market_id")
    distance = planar_distance_m(F.col("projected_x_m"), F.col("projected_y_m"), F.col("anchor_x_m"), F.col("anchor_y_m"))
    finite = F.when(~F.isnan(distance) & (distance < float("inf")), distance)
    rows = joined.withColumn("distance_m", finite).withColumn("radius_m", F.explode(F.array(*[F.lit(r) for r in radii])))
    ordinary = F.col("distance_m") <= F.col("radius_m")
    forced = (F.col("tract_geoid") == F.col("anchor_tract_geoid")) & ~F.coalesce(ordinary, F.lit(False))
    computable = F.col("distance_m").isNotNull()
    return rows.select(
        F.lit(MEMBERSHIP_SPEC).alias("membership_spec_id"), "context_spec_id", "context_instance_id", "market_id", "radius_m", "tract_geoid", "distance_m",
        computable.alias("distance_computable"), ordinary.alias("ordinary_membership"), forced.alias("forced_anchor_inclusion"),
        F.when(forced, True).otherwise(ordinary).alias("final_membership"), reason_code(ordinary, forced, computable).alias("reason_code"),
    )


def context_violations(contexts: DataFrame, points: DataFrame) -> list[DataFrame]:
    """Identity and anchor rules, in the order they are reported."""
    key = F.col("context_instance_id")
    anchors = points.select("market_id", F.col("tract_geoid").alias("anchor_tract_geoid")).distinct()
    return [
        checks.where_not(contexts, F.length("context_spec_id") > 0, 10, "CONTEXT_SPEC_ID_MISSING", key),
        checks.where_not(contexts, F.length("context_instance_id") > 0, 20, "CONTEXT_INSTANCE_ID_MISSING", key),
        checks.where_not(contexts, F.length("anchor_tract_geoid") == 11, 30, "ANCHOR_IDENTITY_MISSING_OR_AMBIGUOUS", key),
        checks.violations(contexts.join(anchors, ["market_id", "anchor_tract_geoid"], "left_anti"), 40, "ANCHOR_TRACT_ABSENT", key),
        checks.where_not(contexts, F.col("anchor_x_m").isNotNull() & F.col("anchor_y_m").isNotNull(), 50, "ANCHOR_TRANSFORM_FAILED", key),
        checks.duplicates(contexts, ["context_instance_id"], 60, "GEO02_CONTEXT_INSTANCE_DUPLICATE"),
    ]


def nesting_violations(members: DataFrame, radii: tuple[float, ...] = RADII_M) -> list[DataFrame]:
    """Each context and tract has exactly the radii, and a member of one is a member of the next."""
    keys = ["context_instance_id", "tract_geoid"]
    by = members.groupBy(*keys).agg(
        F.array_sort(F.collect_set("radius_m")).alias("seen"), F.count("*").alias("n"), *[F.max(F.when(F.col("radius_m") == r, F.col("final_membership"))).alias(f"m{i}") for i, r in enumerate(radii)]
    )
    key = F.concat_ws("/", *keys)
    complete = (F.col("seen") == F.array(*[F.lit(r) for r in sorted(radii)])) & (F.col("n") == len(radii))
    nested = [~F.coalesce(F.col(f"m{i}"), F.lit(False)) | F.coalesce(F.col(f"m{i + 1}"), F.lit(False)) for i in range(len(radii) - 1)]
    found = [checks.where_not(by, complete, 10, "MEMBERSHIP_RADIUS_SET_INVALID", key)]
    return found + [checks.where_not(by, ok, 20 + i, "MEMBERSHIP_NESTING_VIOLATION", key) for i, ok in enumerate(nested)]


def household_evidence(rows: DataFrame) -> DataFrame:
    """rows (estimate, moe, status, ...) with estimate_valid, moe_valid and evidence_valid."""
    good = F.coalesce(F.col("status"), F.lit("missing")) == "valid"
    e, m = (good & F.coalesce(F.col(c) >= 0, F.lit(False)) for c in ("estimate", "moe"))
    return rows.withColumn("status", F.coalesce("status", F.lit("missing"))).withColumn("estimate_valid", e).withColumn("moe_valid", m).withColumn("evidence_valid", F.col("estimate_valid") & F.col("moe_valid"))


def household_violations(tracts: DataFrame, rows: DataFrame) -> list[DataFrame]:
    cover = checks.exact_cover(tracts, rows, ["market_id", "tract_geoid"], 10, "DUPLICATE_ACS_GEOID", "ACS_INVENTORY_MISMATCH")
    return [*cover, checks.where_not(rows, F.coalesce("status", F.lit("missing")).isin(*STATUSES), 30, "ACS_STATUS_INVALID", F.col("tract_geoid"))]


def household_opportunity(members: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row for each context and radius: the sum over member tracts, or why there is none.

    An unknown membership of any tract makes the sum noncomputable; so does a member without valid evidence. Evidence
    is one row per tract and joins on (market_id, tract_geoid); sums are partial before the shuffle.
    """
    e = evidence.select("market_id", "tract_geoid", F.col("estimate").alias("__e"), F.col("evidence_valid").alias("__v"))
    j = members.join(e, ["market_id", "tract_geoid"], "left")
    member = F.coalesce("final_membership", F.lit(False))
    agg = j.groupBy("context_instance_id", "radius_m").agg(
        F.bool_or(F.col("final_membership").isNull()).alias("__unknown"), F.bool_or(member & ~F.coalesce("__v", F.lit(False))).alias("__invalid"),
        F.coalesce(F.sum(F.when(member, F.col("__e"))), F.lit(0)).cast("bigint").alias("__sum"), F.count_if(member).alias("member_count"),
    )
    return stated_sums(agg)


def stated_sums(agg: DataFrame) -> DataFrame:
    bad = F.col("__unknown") | F.col("__invalid")
    reason = F.when(F.col("__unknown"), "NONCOMPUTABLE_TRACT_MEMBERSHIP").when(F.col("__invalid"), "INVALID_MEMBER_ACS_EVIDENCE").otherwise("WHOLE_TRACT_FINAL_MEMBERSHIP_SUM")
    return agg.select(
        "context_instance_id", "radius_m", F.lit("whole_tract_final_membership_once").alias("aggregation_method"), F.when(~bad, F.col("__sum")).alias("household_opportunity"),
        F.when(bad, "noncomputable").otherwise("complete").alias("calculation_state"), reason.alias("reason_code"), "member_count",
    )


def household_sums(contexts: DataFrame, points: DataFrame, evidence: DataFrame, radii: tuple[float, ...] = RADII_M) -> DataFrame:
    """What `household_opportunity` gives for `membership`, without a row for any tract that is no member.

    Members are found by cells about the anchors, within the largest radius; the anchor's own tract is looked up and counts at the
    radii it lies beyond. Tracts whose membership is unknown are only counted, for each market once: a context's are those of
    its market but its own, or all others if the anchor has no place. Evidence is joined to the tracts before they meet contexts.
    Coordinates are metres; null, NaN and infinite ones are unknown. A context whose market has no tract has no row.
    """
    finite = lambda x, y: F.coalesce(~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")), F.lit(False))
    p = points.select("market_id", "tract_geoid", F.col("projected_x_m").alias("__px"), F.col("projected_y_m").alias("__py"), finite(F.col("projected_x_m"), F.col("projected_y_m")).alias("__known"))
    e = evidence.select("market_id", "tract_geoid", F.col("estimate").alias("__e"), F.coalesce("evidence_valid", F.lit(False)).alias("__v"))
    told = p.join(e, ["market_id", "tract_geoid"], "left")
    c = contexts.select("market_id", "context_instance_id", "anchor_tract_geoid", F.col("anchor_x_m").alias("__ax"), F.col("anchor_y_m").alias("__ay"), finite(F.col("anchor_x_m"), F.col("anchor_y_m")).alias("__placed"))
    x, y, reach = F.col("__ax"), F.col("__ay"), max(radii)
    d = planar_distance_m(F.col("__px"), F.col("__py"), x, y)
    each_radius = F.explode(F.array(*[F.lit(r) for r in radii])).alias("radius_m")
    met = within(told.where("__known").drop("__known"), F.col("__px"), F.col("__py"), c.where("__placed").drop("__placed", "anchor_tract_geoid"), around(x, y, reach), reach)
    near = met.withColumn("__d", d).where(F.col("__d") <= reach).select("context_instance_id", "__e", "__v", "__d", each_radius).where("__d <= radius_m")
    own = c.join(told.withColumnRenamed("tract_geoid", "anchor_tract_geoid"), ["market_id", "anchor_tract_geoid"]).withColumn("__d", F.when(F.col("__known") & F.col("__placed"), d))
    forced = own.select("context_instance_id", "__e", "__v", "__d", each_radius).where(~F.coalesce(F.col("__d") <= F.col("radius_m"), F.lit(False)))
    sums = near.unionByName(forced).groupBy("context_instance_id", "radius_m").agg(F.bool_or(~F.coalesce("__v", F.lit(False))).alias("__invalid"), F.sum("__e").alias("__s"), F.count("*").alias("__n"))
    markets = p.groupBy("market_id").agg(F.count("*").alias("__all"), F.count_if(~F.col("__known")).alias("__gaps"))
    mine = p.groupBy("market_id", F.col("tract_geoid").alias("anchor_tract_geoid")).agg(F.count("*").alias("__own"), F.count_if(~F.col("__known")).alias("__own_gaps"))
    rows = c.join(markets, "market_id").join(mine, ["market_id", "anchor_tract_geoid"], "left")
    others = F.when(F.col("__placed"), F.col("__gaps") - F.coalesce("__own_gaps", F.lit(0))).otherwise(F.col("__all") - F.coalesce("__own", F.lit(0)))
    rows = rows.select("context_instance_id", (others > 0).alias("__unknown"), each_radius).join(sums, ["context_instance_id", "radius_m"], "left")
    zero = F.lit(0)
    return stated_sums(rows.select("context_instance_id", "radius_m", "__unknown", F.coalesce("__invalid", F.lit(False)).alias("__invalid"), F.coalesce("__s", zero).cast("bigint").alias("__sum"), F.coalesce("__n", zero).alias("member_count")))


def eligibility(spatial: DataFrame, households: DataFrame, quarantined: Column | None = None) -> DataFrame:
    """Status and reasons of each context from its completeness, Jaccard stress and primary-radius households.

    A context without households is noncomputable, or quarantined if it is; none is lost.

    spatial: context_instance_id, geometric_completeness, geometric_jaccard and, if `quarantined` names one, that column.
    """
    h = households.where(F.col("radius_m") == PRIMARY_RADIUS_M).select("context_instance_id", "calculation_state", F.col("reason_code").alias("__why"))
    j = spatial.withColumn("__q", F.coalesce(quarantined, F.lit(False)) if quarantined is not None else F.lit(False)).join(h, "context_instance_id", "left")
    c = F.col("geometric_completeness")
    status = (
        F.when(F.col("__q"), "quarantined").when(F.coalesce(F.col("calculation_state") != "complete", F.lit(True)), "noncomputable").when(c >= PRIMARY_COMPLETENESS, "primary_statistic_eligible")
        .when(c >= SECONDARY_COMPLETENESS, "secondary_truncated_stratum").otherwise("qa_only")
    )
    j = j.withColumn("eligibility_status", status)
    s = F.col("eligibility_status")
    first = F.when(s == "quarantined", "MODEL04_QUARANTINE").when(s == "noncomputable", F.coalesce("__why", F.lit("HOUSEHOLD_EVIDENCE_ABSENT"))).when(s == "secondary_truncated_stratum", "GEOMETRIC_COMPLETENESS_0_75_TO_LT_0_90").when(s == "qa_only", "GEOMETRIC_COMPLETENESS_LT_0_75")
    reasons = F.array_compact(F.array(first, F.when(F.col("geometric_jaccard") >= JACCARD_STRESS, "GEOMETRIC_JACCARD_GTE_0_25")))
    flags = [(s == x).alias(x) for x in ("primary_statistic_eligible", "secondary_truncated_stratum", "qa_only", "quarantined", "noncomputable")]
    return j.select("context_instance_id", "eligibility_status", *flags, reasons.alias("reason_codes"))


def eligibility_histogram(status: DataFrame) -> DataFrame:
    return status.groupBy("eligibility_status").agg(F.count("*").alias("n"))


def baseline_prediction(households: DataFrame, spec: dict) -> DataFrame:
    """The complete primary-radius opportunity of each context as its prediction, under an accepted parameter-free spec."""
    needed = ("model_spec_id", "model_spec_version", "preregistration_id", "preregistration_version", "prediction_semantics", "accepted")
    if missing := sorted(set(needed) - set(spec)):
        raise checks.ConformanceError("MODEL_SPEC_INCOMPLETE", str(missing))
    if spec["accepted"] is not True:
        raise checks.ConformanceError("MODEL_SPEC_NOT_ACCEPTED")
    if spec["prediction_semantics"] != "raw_5_mile_whole_tract_household_opportunity":
        raise checks.ConformanceError("MODEL_SEMANTICS_UNAUTHORIZED")
    if spec.get("numerical_parameters"):
        raise checks.ConformanceError("UNAUTHORIZED_MODEL_PARAMETERS")
    stated = [F.lit(spec[k]).alias(k) for k in ("prediction_semantics", *needed[:4])]
    chosen = households.where((F.col("radius_m") == PRIMARY_RADIUS_M) & (F.col("calculation_state") == "complete"))
    return chosen.select("context_instance_id", "radius_m", F.lit("primary").alias("role"), F.col("household_opportunity").alias("prediction_candidate"), *stated)


def spatial_violations(spatial: DataFrame) -> list[DataFrame]:
    """The contract of spatial evidence: no competing Jaccard column, all fields, and shares within [0, 1]."""
    needed = ("context_spec_id", "context_instance_id", "market_edge_state", "geometric_completeness", "geometric_jaccard", "spatial_components", "geo02_lineage")
    if any("membership_jaccard" in c.lower() for c in spatial.columns):
        raise checks.ConformanceError("COMPETING_MEMBERSHIP_JACCARD_REJECTED")
    if missing := sorted(set(needed) - set(spatial.columns)):
        raise checks.ConformanceError("GEO02_SPATIAL_EVIDENCE_INCOMPLETE", str(missing))
    return [
        checks.where_not(spatial, F.col(c).between(0.0, 1.0) & ~F.isnan(c), 10 + i, code, F.col("context_instance_id"))
        for i, (c, code) in enumerate((("geometric_completeness", "COMPLETENESS_INVALID"), ("geometric_jaccard", "JACCARD_INVALID")))
    ]
