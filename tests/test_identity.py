import random

import pytest
import sequential_identity
from pyspark.sql import functions as F

from tractloom.operators import binding, checks, governance
from tractloom.operators import identity as I

ROWS = "source_workbook_identity string, source_workbook_order int, source_sheet string, source_row int, vintage string, seed_point_id string, address string, city string, state string, zip string, market string, latitude double, longitude double, latitude_text string, longitude_text string"
DEV = I.DEVELOPMENT_WORKBOOK


def row(book, n, year, seed, lat, address=None, market="Milwaukee", lon=-20.0):
    return (book, 0 if book == DEV else 1, "Sheet1", n, str(year), seed, address or f"{n} Fictional Ave", market, "WI", "00000", market, lat, lon, repr(lat), repr(lon))


def resolve(spark, rows):
    prepared = I.prepare_locations(spark.createDataFrame(rows, ROWS))
    checks.require_none(I.location_violations(prepared))
    out = I.resolve(prepared)
    return out, {r.source_seed_point_id: r for r in out.collect()}


def test_cascade(spark):
    rows = [
        row(DEV, 2, 2024, "DEV-A", 10.0, "1 Fictional Ave"), row(DEV, 3, 2024, "DEV-B", 10.02, "2 Fictional Ave"), row("NEW", 2, 2026, "RENAMED-A", 10.0, "1 Fictional Ave"),
        row("NEW", 3, 2026, "RENAMED-B", 10.020005, "2 Fictional Avenue"), row("NEW", 4, 2026, "AMB", 10.023, "4 Fictional Ave"), row("NEW", 5, 2026, "NEW", 10.1, "5 Fictional Ave"),
    ]
    out, r = resolve(spark, rows)
    assert r["RENAMED-A"].identity_state == I.SAME and r["RENAMED-A"].anchor_source_seed_point_id == "DEV-A" and r["RENAMED-A"].evidence_role == "TEMPORAL_VALIDATION"
    assert r["RENAMED-B"].identity_state == I.PROBABLE and r["RENAMED-B"].physical_location_id == r["DEV-B"].physical_location_id
    assert r["AMB"].identity_state == I.AMBIGUOUS and r["AMB"].quarantined and r["AMB"].anchor_latitude is None and r["AMB"].physical_location_id.startswith("qloc-")
    assert r["NEW"].identity_state == I.NEW and r["NEW"].evidence_role == "PROSPECTIVE_MILWAUKEE_HOLDOUT"
    checks.require_none(I.identity_violations(out))
    s = I.package_summary(out).first()
    assert (s.record_count, s.physical_location_count, s.quarantine_count) == (6, 4, 1)
    pairs, bad = I.temporal_pairs(out)
    checks.require_none(bad)
    assert {(p.prior.source_seed_point_id, p.current.source_seed_point_id) for p in pairs.collect()} == {("DEV-A", "RENAMED-A"), ("DEV-B", "RENAMED-B")}
    assert sorted(p.pipe_context_ordinal for p in pairs.collect()) == [1, 2] and I.requested_pairs(pairs).count() == 4
    with pytest.raises(checks.ConformanceError, match="MODEL04_ANCHOR_SELECTION_MISMATCH"):
        checks.require_none(I.identity_violations(out.withColumn("anchor_latitude", F.col("anchor_latitude") + 1)))
    with pytest.raises(checks.ConformanceError, match="MODEL04_QUARANTINE_MISMATCH"):
        checks.require_none(I.identity_violations(out.withColumn("quarantined", F.lit(False))))


def test_other_cases(spark):
    _, r = resolve(spark, [row(DEV, 2, 2024, "A", 10.0), row("NEW", 9, 2026, "B", 10.0, "other"), row("NEW", 10, 2026, "A", 11.0, "far")])
    assert r["B"].identity_state == I.SAME
    out, _ = resolve(spark, [row(DEV, 2, 2024, "A", 10.0), row("NEW", 10, 2026, "A", 11.0, "far")])
    assert {(x.source_row, x.identity_state) for x in out.collect()} == {(2, I.NEW), (10, I.AMBIGUOUS)}
    _, r = resolve(spark, [row(DEV, 7, 2024, "X", 10.0, "1 a"), row(DEV, 3, 2024, "Y", 10.0, "1 b"), row("NEW", 2, 2026, "Z", 10.0, "1 c")])
    assert r["Z"].anchor_source_row == 3
    _, r = resolve(spark, [row(DEV, 2, 2024, "A", 10.0, market="Madison"), row("NEW", 2, 2025, "B", 10.0, "q", market="Madison"), row("NEW", 3, 2026, "C", 12.0, "z", market="Madison")])
    assert r["B"].evidence_subrole == "MADISON_REPEATED_LOCATION_EVIDENCE" and r["C"].evidence_subrole == "MADISON_2026_GENUINELY_NEW_LOCATION"
    # Within 10 m of a prior group but not corroborated, and nothing from 10 to 500 m: new.
    odd = list(row("NEW", 2, 2026, "B", 10.00001, "elsewhere"))
    odd[7], odd[9] = "Milwaukee North", "11111"
    _, r = resolve(spark, [row(DEV, 2, 2024, "A", 10.0), tuple(odd)])
    assert r["B"].identity_state == I.NEW


def decisions(records):
    return {(r["source_workbook_identity"], r["source_row"]): tuple(r[c] for c in ("identity_state", "identity_rule_reason_code", "physical_location_id", *[f"anchor_{c}" for c in I.ANCHOR])) for r in records}


@pytest.mark.parametrize("seed", range(3))
def test_waves_equal_the_rules_in_order(spark, seed):
    """Crowded places, three vintages, seeds and addresses that recur near and far, points of other precision and within 10 m."""
    rng = random.Random(seed)
    rows = []
    for k in range(220):
        year = rng.choice([2024, 2025, 2026])
        lat, lon = 10 + rng.randrange(30) * 0.0021 + rng.choice([0, 0, 0.00004, 0.000071, 0.003]), -20 + rng.randrange(3) * 0.0043
        digits = rng.choice([6, 6, 4])
        x = list(row(DEV if year == 2024 else f"NEW{rng.randrange(2)}", k + 2, year, rng.choice([f"S{rng.randrange(70)}", f"U{k}", f"U{k}", ""]), round(lat, digits), f"{rng.choice([rng.randrange(60), k + 1000])} Ave", lon=round(lon, digits), market=rng.choice(["Milwaukee", "Milwaukee", "Madison"])))
        x[9] = rng.choice(["00000", "00001", ""])
        rows.append(tuple(x))
    for k in range(25):  # places seen again at four decimals, some of them twice
        lat = 30 + k * 0.05 + rng.uniform(0, 0.001)
        rows.append(row(DEV, k + 5000, 2024, f"P{k}", round(lat, 6), f"{k} Place"))
        rows += [row("NEW0", k + 5000 + 100 * n, 2026, f"Q{k}{n}", round(lat + rng.choice([0, 0, 0.00005]), 4), f"{k} Place {n}") for n in range(rng.choice([1, 1, 2]))]
    prepared = I.prepare_locations(spark.createDataFrame(rows, ROWS)).cache()
    groups = {}
    for r in prepared.collect():
        groups.setdefault((r.market, r.state_norm), []).append(r.asDict())
    want = decisions(x for g in groups.values() for x in sequential_identity.resolve_block(g))
    assert decisions(r.asDict() for r in I.resolve(prepared).collect()) == want
    assert {s for s, *_ in want.values()} == {I.SAME, I.PROBABLE, I.AMBIGUOUS, I.NEW}


def test_a_chain_of_places_takes_few_waves(spark):
    """Places 400 m apart in one row, each seen again twice a few metres off: one block of all, settled in a handful of waves."""
    rows = []
    for k in range(1500):
        lat = 10 + k * 0.0036
        rows.append(row(DEV, k + 2, 2024, f"A{k}", round(lat, 6), f"{k} Ave"))
        rows.append(row("NEW", k + 2, 2025, f"B{k}", round(lat, 6), f"{k} Street"))
        rows.append(row("NEW", k + 5002, 2026, f"A{k}", round(lat + 0.00003, 6), f"{k} Road"))
    records = I.in_order(I.prepare_locations(spark.createDataFrame(rows, ROWS)))
    told = I.assignment(records, most_waves=6)
    assert told.join(records.select("__at", "vintage_year"), "__at").groupBy("vintage_year", "why").count().count() == 3 and told.where("place is not null").select("place").distinct().count() == 1500


def test_later_waves_decide_only_what_may_change(spark, monkeypatch):
    """Lone places seen twice, which the first wave settles, and a chain in which a record waits for the one before it."""
    rows = [row(DEV, k + 2, 2024, f"A{k}", 10 + k * 0.05, f"{k} Ave") for k in range(40)] + [row("NEW", k + 2, 2026, f"B{k}", 10 + k * 0.05, f"{k} Street") for k in range(40)]
    rows += [row(DEV, 900, 2024, "X0", 40.0, "x"), row("NEW", 901, 2025, "X0", 40.003, "y"), row("NEW", 902, 2026, "X2", 40.006, "y")]
    prepared = I.prepare_locations(spark.createDataFrame(rows, ROWS)).cache()
    records, dues, wave = I.in_order(prepared), [], I.wave

    def counted(records, near, close, assigned, due=None):
        dues.append(None if due is None else due.count())
        return wave(records, near, close, assigned, due)

    monkeypatch.setattr(I, "wave", counted)
    told = {r.source_row: r.place for r in I.assignment(records).join(records.select("__at", "source_row", "source_seed_point_id"), "__at").where("source_seed_point_id like 'X%'").collect()}
    assert told[900] == told[901] == told[902] and dues[0] is None and len(dues) > 1 and all(n <= 3 for n in dues[1:])


def test_counts_before(spark, monkeypatch):
    monkeypatch.setattr(I, "RANGE", 7)
    rng = random.Random(1)
    rows, asks = [(rng.choice("ab"), k) for k in rng.sample(range(200), 120)], [(rng.choice("abc"), k) for k in rng.sample(range(220), 90)]
    got = I.counted_before(spark.createDataFrame(rows, "k string, __at long"), ["k"], spark.createDataFrame(asks, "k string, __at long"))
    assert sorted(map(tuple, got.collect())) == sorted((k, at, sum(a == k and b < at for a, b in rows)) for k, at in asks)


def test_location_checks(spark):
    bad = list(row(DEV, 2, 2024, "A", 10.0))
    for at, value, code in ((11, 95.0, "MODEL04_COORDINATE_INVALID"), (4, "none", "MODEL04_VINTAGE_INVALID")):
        changed = [*bad[:at], value, *bad[at + 1 :]]
        with pytest.raises(checks.ConformanceError, match=code):
            checks.require_none(I.location_violations(I.prepare_locations(spark.createDataFrame([tuple(changed)], ROWS))))
    with pytest.raises(checks.ConformanceError, match="MODEL04_MARKET_INVALID"):
        checks.require_none(I.location_violations(I.prepare_locations(spark.createDataFrame([row(DEV, 2, 2024, "A", 10.0, market="Racine")], ROWS))))
    with pytest.raises(checks.ConformanceError, match="MODEL04_SOURCE_EMPTY"):
        checks.require_none(I.location_violations(I.prepare_locations(spark.createDataFrame([], ROWS))))


def test_binding(spark):
    sheet = spark.createDataFrame([("A", 2024, "J2"), ("A", 2025, "J3"), ("B", 2024, "J4"), ("C", 2024, "J5"), ("C", 2024, "J6")], "lineage_key string, vintage_year int, target_address string")
    ask = lambda *rows: spark.createDataFrame(list(rows), "physical_location_id string, source_role string, lineage_key string, vintage_year int")
    bound, bad = binding.bind_requests(ask(("L", "p", "A", 2024), ("L", "c", "A", 2025)), sheet)
    checks.require_none(bad)
    wide, bad = binding.pair_by_role(bound, ["p", "c"])
    checks.require_none(bad)
    assert tuple(wide.first()) == ("L", "J2", "J3")
    for rows, code in (([("L", "p", "A", 2024), ("M", "p", "A", 2024)], "TARGET_REQUEST_DUPLICATE"), ([("L", "p", "C", 2024)], "TARGET_JOIN_AMBIGUOUS"), ([("L", "p", "Z", 2024)], "TARGET_JOIN_UNRESOLVED")):
        with pytest.raises(checks.ConformanceError, match=code):
            checks.require_none(binding.bind_requests(ask(*rows), sheet)[1])
    with pytest.raises(checks.ConformanceError, match="PAIR_ROLE_MISSING"):
        checks.require_none(binding.pair_by_role(bound.limit(1), ["p", "c"])[1])
    m = lambda **kv: spark.createDataFrame(list(kv.items()), "key string, value string")
    assert sorted(r.key for r in binding.reconcile_maps(m(a="1", b="2", c="3"), m(a="1", b="9", d="4")).collect()) == ["b", "c", "d"]


def manifest(**change):
    base = dict(
        task_id="PIPE-01B", title="t", capability_owner="o", authority_source="s", state="COMPLETED_AWAITING_ACCEPTANCE", scope=["a"], exclusions=["b"], accepted_input_artifacts=["GEO03_X_V1"], protected_dependency_logical_ids=["PROTECTED_X_V1"],
        implementation_branch="task/pipe-01b-build", implementation_commit="abcdef1", completion_state=("COMPLETED", ["TEST_PASS"], "NOT_REVIEWED"), acceptance_destination="d", acceptance_disposition=None, acceptance_metadata=None, exact_next_destination="n",
    )
    return base | change


MANIFEST = "task_id string, title string, capability_owner string, authority_source string, state string, scope array<string>, exclusions array<string>, accepted_input_artifacts array<string>, protected_dependency_logical_ids array<string>, implementation_branch string, implementation_commit string, completion_state struct<execution:string,implementation_evidence:array<string>,capability_acceptance:string>, acceptance_destination string, acceptance_disposition string, acceptance_metadata struct<capability_owner:string,recorded_by:string,recorded_on:string>, exact_next_destination string"


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({}, None), ({"task_id": "PIPE-1"}, "TASK_ID_INVALID"), ({"state": "x"}, "TASK_STATE_INVALID"), ({"title": ""}, "TASK_MANIFEST_FIELD_INVALID"), ({"accepted_input_artifacts": ["bad"]}, "TASK_MANIFEST_LOGICAL_ID_INVALID"),
        ({"implementation_branch": "task/pipe-02-x"}, "TASK_BRANCH_INVALID"), ({"completion_state": ("COMPLETED", ["NOPE"], "NOT_REVIEWED")}, "TASK_EVIDENCE_INVALID"), ({"state": "ACCEPTED_CLOSED"}, "TASK_ACCEPTANCE_METADATA_REQUIRED"),
        ({"completion_state": ("IN_PROGRESS", [], "NOT_REVIEWED")}, "TASK_COMPLETION_ACCEPTANCE_MISMATCH"), ({"title": "at 43.12345, -87.12345"}, "TASK_MANIFEST_PROTECTED_CONTENT"), ({"scope": ["/etc/x"]}, "TASK_MANIFEST_PROTECTED_CONTENT"),
        ({"state": "ACCEPTED_CLOSED", "acceptance_disposition": "ACCEPTED", "acceptance_metadata": ("o", "r", "2026-01-02"), "completion_state": ("COMPLETED", [], "ACCEPTED")}, None),
    ],
)
def test_manifests(spark, change, code):
    found = governance.manifest_violations(spark.createDataFrame([tuple(manifest(**change).values())], MANIFEST))
    if code is None:
        checks.require_none(found)
    else:
        with pytest.raises(checks.ConformanceError, match=code):
            checks.require_none(found)


def test_paths_and_reports(spark):
    p = spark.createDataFrame([("a/READY.json",), ("schemas/x/ready.json",), ("b/notes.md",), ("FROZEN.json/x",)], "path string")
    assert sorted(r.path for r in governance.protected_paths(p, ["READY.json", "FROZEN.json"]).collect()) == ["FROZEN.json/x", "a/READY.json"]
    report = spark.createDataFrame([(1, ("x",))], "n int, d struct<latitude:string>")
    with pytest.raises(checks.ConformanceError, match="DISCLOSURE_PROTECTED_KEY"):
        checks.require_none(governance.disclosure_violations(report, ["n", "d"], governance.PROHIBITED_TERMS))
    with pytest.raises(checks.ConformanceError, match="DISCLOSURE_FIELDS_INVALID"):
        governance.disclosure_violations(report, ["n"], frozenset())
    j = spark.createDataFrame([('{"Path ": 1, "k": 2}',), ("[1]",), (None,)], "j string").select(checks.forbidden_json_keys(F.col("j"), frozenset({"path"}))).collect()
    assert [r[0] for r in j] == [["Path "], [], []]
