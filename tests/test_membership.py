import math
import random

import pytest
from pyspark.sql import functions as F

from tractloom.operators import checks
from tractloom.operators import membership as M

POINTS = "market_id string, tract_geoid string, INTPTLAT string, INTPTLON string"
KM = lambda lon, lat: F.struct((lon * 1000).alias("x"), (lat * 1000).alias("y"))
G1, G2 = "00000000001", "00000000002"


def points(spark, first=("0.000", "0"), second=("0", "6")):
    return M.internal_points(spark.createDataFrame([("m", G1, *first), ("m", G2, *second), ("other", "00000000009", "0", "0")], POINTS), project=KM)


def context(spark, x=0.0, y=0.0):
    return spark.createDataFrame([("m", "geo02", "ctx-a", G1, x, y)], "market_id string, context_spec_id string, context_instance_id string, anchor_tract_geoid string, anchor_x_m double, anchor_y_m double")


def finals(df):
    return {(r.tract_geoid, r.radius_m): (r.final_membership, r.forced_anchor_inclusion, r.reason_code, r.distance_computable) for r in df.collect()}


def test_radii(spark):
    got = finals(M.membership(context(spark), points(spark)))
    assert len(got) == 6 and [got[G2, r][0] for r in M.RADII_M] == [False, True, True]
    assert all(got[G1, r] == (True, False, "ordinary_radius_membership", True) for r in M.RADII_M)


def test_anchor_is_forced(spark):
    far = finals(M.membership(context(spark), points(spark, first=("0", "9"))))
    assert [far[G1, r][1] for r in M.RADII_M] == [True, True, False] and far[G1, M.RADII_M[0]][2] == "valid_anchor_forced_inclusion_outside_radius"
    gap = finals(M.membership(context(spark), points(spark, first=(None, "0"))))
    assert all(gap[G1, r] == (True, True, "valid_anchor_forced_inclusion_internal_point_gap", False) for r in M.RADII_M)
    unknown = finals(M.membership(context(spark), points(spark, second=("0", None))))
    assert all(unknown[G2, r] == (None, False, "nonanchor_membership_noncomputable", False) for r in M.RADII_M)


def test_exact_boundary(spark):
    r = M.RADII_M[1]
    for d, member in ((r, True), (math.nextafter(r, math.inf), False)):
        p = spark.createDataFrame([("m", G1, 0.0, 0.0), ("m", G2, d, 0.0)], "market_id string, tract_geoid string, projected_x_m double, projected_y_m double")
        assert finals(M.membership(context(spark), p))[G2, r][0] is member


def evidence(spark, second=(200, 20, "valid")):
    return M.household_evidence(spark.createDataFrame([("m", G1, 100, 10, "valid"), ("m", G2, *second)], "market_id string, tract_geoid string, estimate long, moe long, status string"))


@pytest.mark.parametrize(
    ("second", "at_3", "at_5"),
    [((200, 20, "valid"), 100, 300), ((None, 20, "suppressed"), 100, None), ((200, None, "valid"), 100, None), ((200, 20, "invalid"), 100, None), ((200, 20, None), 100, None)],
)
def test_households(spark, second, at_3, at_5):
    rows = {r.radius_m: r for r in M.household_opportunity(M.membership(context(spark), points(spark)), evidence(spark, second)).collect()}
    assert [rows[r].household_opportunity for r in M.RADII_M[:2]] == [at_3, at_5] and [rows[r].member_count for r in M.RADII_M] == [1, 2, 2]
    if at_5 is None:
        assert rows[M.RADII_M[1]].reason_code == "INVALID_MEMBER_ACS_EVIDENCE" and rows[M.RADII_M[1]].calculation_state == "noncomputable"


def test_unknown_membership_poisons_all(spark):
    rows = M.household_opportunity(M.membership(context(spark), points(spark, second=(None, "6"))), evidence(spark)).collect()
    assert {(r.household_opportunity, r.reason_code) for r in rows} == {(None, "NONCOMPUTABLE_TRACT_MEMBERSHIP")}
    lone = M.household_opportunity(M.membership(context(spark), points(spark)), evidence(spark).where("estimate = 100")).collect()
    assert {r.radius_m: r.reason_code for r in lone}[M.RADII_M[1]] == "INVALID_MEMBER_ACS_EVIDENCE"


@pytest.mark.parametrize(
    ("c", "j", "held", "status", "reasons"),
    [
        (0.90, 0.1, False, "primary_statistic_eligible", []), (0.75, 0.25, False, "secondary_truncated_stratum", ["GEOMETRIC_COMPLETENESS_0_75_TO_LT_0_90", "GEOMETRIC_JACCARD_GTE_0_25"]),
        (0.749999, 0.0, False, "qa_only", ["GEOMETRIC_COMPLETENESS_LT_0_75"]), (0.95, 0.3, True, "quarantined", ["MODEL04_QUARANTINE", "GEOMETRIC_JACCARD_GTE_0_25"]),
    ],
)
def test_eligibility(spark, c, j, held, status, reasons):
    s = spark.createDataFrame([("ctx-a", c, j, held)], "context_instance_id string, geometric_completeness double, geometric_jaccard double, held boolean")
    h = M.household_opportunity(M.membership(context(spark), points(spark)), evidence(spark))
    r = M.eligibility(s, h, F.col("held")).first()
    assert (r.eligibility_status, r.reason_codes) == (status, reasons) and r[status] is True
    bad = M.household_opportunity(M.membership(context(spark), points(spark)), evidence(spark, (None, None, "missing")))
    if not held:
        assert M.eligibility(s, bad).first().reason_codes[0] == "INVALID_MEMBER_ACS_EVIDENCE"


def test_baseline(spark):
    h = M.household_opportunity(M.membership(context(spark), points(spark)), evidence(spark))
    spec = dict(model_spec_id="a", model_spec_version="1", preregistration_id="p", preregistration_version="1", prediction_semantics="raw_5_mile_whole_tract_household_opportunity", accepted=True)
    assert M.baseline_prediction(h, spec).first().prediction_candidate == 300
    for change, code in (({"accepted": False}, "MODEL_SPEC_NOT_ACCEPTED"), ({"prediction_semantics": "x"}, "MODEL_SEMANTICS_UNAUTHORIZED"), ({"numerical_parameters": [1]}, "UNAUTHORIZED_MODEL_PARAMETERS")):
        with pytest.raises(checks.ConformanceError, match=code):
            M.baseline_prediction(h, spec | change)
    with pytest.raises(checks.ConformanceError, match="MODEL_SPEC_INCOMPLETE"):
        M.baseline_prediction(h, {"accepted": True})


def test_checks(spark):
    m = M.membership(context(spark), points(spark))
    checks.require_none(M.nesting_violations(m))
    with pytest.raises(checks.ConformanceError, match="MEMBERSHIP_RADIUS_SET_INVALID"):
        checks.require_none(M.nesting_violations(m.where("radius_m > 5000")))
    broken = m.withColumn("final_membership", F.when((F.col("tract_geoid") == G1) & (F.col("radius_m") == M.RADII_M[1]), False).otherwise(F.col("final_membership")))
    with pytest.raises(checks.ConformanceError, match="MEMBERSHIP_NESTING_VIOLATION"):
        checks.require_none(M.nesting_violations(broken))
    tracts = points(spark).where("market_id = 'm'").select("market_id", "tract_geoid")
    with pytest.raises(checks.ConformanceError, match="DUPLICATE_ACS_GEOID"):
        checks.require_none(M.household_violations(tracts, evidence(spark).unionAll(evidence(spark))))
    with pytest.raises(checks.ConformanceError, match="ACS_INVENTORY_MISMATCH"):
        checks.require_none(M.household_violations(tracts, evidence(spark).limit(1)))
    with pytest.raises(checks.ConformanceError, match="ACS_STATUS_INVALID"):
        checks.require_none(M.household_violations(tracts, evidence(spark, (1, 1, "mystery"))))
    with pytest.raises(checks.ConformanceError, match="ANCHOR_TRACT_ABSENT"):
        checks.require_none(M.context_violations(context(spark).withColumn("anchor_tract_geoid", F.lit("00000000007")), points(spark)))
    s = spark.createDataFrame([("s", "c", "e", 1.2, 0.1, "x", "y")], "context_spec_id string, context_instance_id string, market_edge_state string, geometric_completeness double, geometric_jaccard double, spatial_components string, geo02_lineage string")
    with pytest.raises(checks.ConformanceError, match="COMPLETENESS_INVALID"):
        checks.require_none(M.spatial_violations(s))
    with pytest.raises(checks.ConformanceError, match="COMPETING"):
        M.spatial_violations(s.withColumn("Membership_Jaccard_x", F.lit(1)))


def test_inventory(spark):
    t = spark.createDataFrame([("55", "079", "000100", "55079000100"), ("55", "089", "000100", "55089000100"), ("55", "025", "000200", "55025000200")], "STATEFP string, COUNTYFP string, TRACTCE string, GEOID string")
    chosen, found = M.derive_inventory(t, [("mke", "55079"), ("mke", "55089")])
    checks.require_none(found)
    rows = {(r.tract_geoid, r.ordinal_position) for r in M.inventory(chosen).collect()}
    assert rows == {("55079000100", 1), ("55089000100", 2)}
    for df, counties, code in (
        (t, [("mke", "55131")], "GEO04_COUNTY_RECONCILIATION_FAILED"), (t.unionAll(t.limit(1)), [("mke", "55079")], "GEO04_DUPLICATE_CANONICAL_GEOID"),
        (t.withColumn("TRACTCE", F.lit("000300")), [("mke", "55079")], "GEO04_GEOID_COMPONENT_MISMATCH"), (t.withColumn("STATEFP", F.lit("5x")), [("mke", "55079")], "GEO04_SOURCE_COMPONENT_INVALID"),
    ):
        with pytest.raises(checks.ConformanceError, match=code):
            checks.require_none(M.derive_inventory(df, counties)[1])
    many = spark.range(3000).select(F.lit("m").alias("market_id"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**11)).cast("string"), 11, "0").alias("tract_geoid"))
    got = M.inventory(many).orderBy("ordinal_position").collect()
    assert [r.ordinal_position for r in got] == list(range(1, 3001)) and [r.tract_geoid for r in got] == sorted(r.tract_geoid for r in got)


def test_stream(spark, tmp_path):
    from tractloom.streaming import stream_membership

    context(spark).write.parquet(str(tmp_path / "in"))
    q = stream_membership(spark.readStream.schema(context(spark).schema).parquet(str(tmp_path / "in")), points(spark)).writeStream.format("memory").queryName("members").start()
    q.processAllAvailable()
    q.stop()
    assert finals(spark.table("members")) == finals(M.membership(context(spark), points(spark)))


def test_sums_without_the_product(spark):
    """Equal to the sums over all rows of membership: unknown places, absent and unplaced anchors, absent evidence, an empty market."""
    rng = random.Random(6)
    place = lambda: rng.choice([None, float("nan"), float("inf")]) if rng.random() < 0.01 else rng.uniform(-20_000, 20_000)
    p = [(f"m{k % 7}", f"{k:011d}", place(), place()) for k in range(500)] + [("m0", "00000000900", 0.0, 0.0), ("alone", "00000000901", None, 0.0)]
    xy = {(m, t): (x, y) for m, t, x, y in p}
    c = [(m, "s", f"c{i}", t, *xy[m, t]) for i, (m, t) in enumerate(rng.sample(sorted(xy), 60))]
    c += [("m1", "s", "absent", "00000000999", 0.0, 0.0), ("m2", "s", "nowhere", "00000000002", None, 1.0), ("m3", "s", "null", None, 5.0, 5.0), ("none", "s", "empty", "x", 0.0, 0.0), ("alone", "s", "alone", "00000000901", None, 0.0), ("m4", "s", "moved", "00000000004", 90_000.0, 0.0)]
    h = [(m, t, rng.randint(0, 900), 5, "valid" if rng.random() < 0.99 else "invalid") for m, t, _, _ in p if rng.random() < 0.99]
    points = spark.createDataFrame(p, "market_id string, tract_geoid string, projected_x_m double, projected_y_m double")
    contexts = spark.createDataFrame(c, "market_id string, context_spec_id string, context_instance_id string, anchor_tract_geoid string, anchor_x_m double, anchor_y_m double")
    given = M.household_evidence(spark.createDataFrame(h, "market_id string, tract_geoid string, estimate long, moe long, status string"))
    want = sorted(map(repr, M.household_opportunity(M.membership(contexts, points), given).collect()))
    assert sorted(map(repr, M.household_sums(contexts, points, given).collect())) == want
    assert len(want) == 3 * 65 and len({r for r in want if "'complete'" in r}) > 10 and len({r for r in want if "INVALID_MEMBER" in r}) > 3
