import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tractloom.functions import geometry as G
from tractloom.operators import checks, spatial

R = 8046.72
TRACTS = f"market_id string, tract_geoid string, polygons {G.POLYGONS}"
CONTEXTS = "context_instance_id string, context_spec_id string, market_id string, anchor_x_m double, anchor_y_m double"


def box(x0, y0, x1, y1):
    return [({"x": float(x), "y": float(y)}) for x, y in ((x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0))]


def ring_of(points):
    return [{"x": x, "y": y} for x, y in points.tolist()]


def tracts(spark, *boxes):
    return spark.createDataFrame([("m", f"{i:011d}", [{"outer": box(*b), "holes": []}]) for i, b in enumerate(boxes)], TRACTS)


def contexts(spark, *at):
    return spark.createDataFrame([(f"c{i}", "s", "m", float(x), float(y)) for i, (x, y) in enumerate(at)], CONTEXTS)


def test_whole_and_half_support(spark):
    whole = spatial.spatial_evidence(contexts(spark, (0, 0)), tracts(spark, (-R, -R, R, R))).first()
    assert whole.geometric_completeness == 1.0 and whole.market_edge_state == "not_truncated" and whole.positive_area_tract_count == 1
    assert whole.anchor_to_market_boundary_m == pytest.approx(R) and whole.footprint_edge_margin_m == pytest.approx(0.0, abs=1e-6)
    half = spatial.spatial_evidence(contexts(spark, (0, 0)), tracts(spark, (-R, -R, 0, R))).first()
    assert half.geometric_completeness == pytest.approx(0.5) and half.market_edge_state == "truncated" and half.anchor_to_market_boundary_m == 0.0


def test_overlap_and_components(spark):
    grid = [(x, y, x + 2 * R, y + 2 * R) for x in np.arange(-4 * R, 12 * R, 2 * R) for y in (-4 * R, -2 * R, 0, 2 * R)]
    rows = {r.context_instance_id: r for r in spatial.spatial_evidence(contexts(spark, (0, 0), (1000, 0), (9 * R, 0)), tracts(spark, *grid)).collect()}
    assert rows["c0"].geometric_jaccard == pytest.approx(0.85345, abs=1e-5) and rows["c0"].jaccard_dependence_stress
    assert rows["c0"].component_id == rows["c1"].component_id != rows["c2"].component_id and rows["c0"].component_size == 2
    assert rows["c2"].geometric_jaccard == 0.0 and rows["c2"].threshold_neighbor_count == 0 and rows["c2"].component_size == 1
    assert all(r.geometric_completeness == pytest.approx(1.0) for r in rows.values())


def test_anchor_binding(spark):
    t = tracts(spark, (0, 0, 1, 1), (1, 0, 2, 1))
    a = lambda x, y: spark.createDataFrame([("c", "m", float(x), float(y))], "context_instance_id string, market_id string, longitude double, latitude double")
    found, bad = spatial.bind_anchors(a(0.5, 0.5), t)
    checks.require_none(bad)
    assert found.first().anchor_tract_geoid == "00000000000"
    assert spatial.bind_anchors(a(0, 0), t)[0].count() == 1
    for x, y in ((1, 0.5), (5, 5)):
        with pytest.raises(checks.ConformanceError, match="GEO02_ANCHOR_TRACT_BINDING_AMBIGUOUS"):
            checks.require_none(spatial.bind_anchors(a(x, y), t)[1])


def test_clipping_equals_half_plane_clipping():
    rng = np.random.default_rng(1)
    w = G.footprint(100, 200, 1000.0)
    window = G.Window(w)
    for _ in range(400):
        n, c = rng.integers(3, 9), rng.uniform(-1500, 1500, 2)
        t, r = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(50, 2500, n)
        if np.diff(np.append(t, t[0] + 2 * np.pi)).max() < np.pi:
            ring = np.column_stack([c[0] + r * np.cos(t), c[1] + r * np.sin(t)])
            assert abs(window.ring_area(ring)) == pytest.approx(abs(G.area(G.clip(ring, w))), abs=1e-4)
            for reach in (1e-9, 1.0, 1400.0):
                at = np.array([100.0, 200.0]) + rng.uniform(-reach, reach, 2)
                both = abs(G.area(G.clip(G.clip(ring, w), G.footprint(*at, 1000.0))))
                common = G.common_window(at - (100, 200), 1000.0)
                assert (abs(common.ring_area(ring - (100, 200))) if common else 0.0) == pytest.approx(both, abs=1e-3)
                g = pa.array([None, [{"outer": ring_of(ring), "holes": []}], [{"outer": ring_of(ring), "holes": [ring_of(ring)]}]], G.ARROW_POLYGONS)
                assert G.common_clipped_areas(g, np.array([[100.0, 200.0, *at]] * 3), 1000.0) == pytest.approx([0, both, 0], abs=1e-3)


def test_touching_footprints():
    """Rims that cross within single sides, and the sum over a plane of squares."""
    r = 1000.0
    for shift in ([2 * r * np.cos(np.pi / 256) - 0.3, 0.1], [1999.0, 3.0], [2001.0, 0.0], [10.0, -1500.0]):
        one, other = G.footprint(0, 0, r), G.footprint(*shift, r)
        window = G.common_window(np.array(shift), r)
        assert (window.area if window else 0.0) == pytest.approx(abs(G.area(G.clip(one, other))), abs=1e-6)
    squares = [[{"outer": [{"x": float(x), "y": float(y)} for x, y in ((i, j), (i + 500, j), (i + 500, j + 500), (i, j + 500))], "holes": []}] for i in range(-2000, 2000, 500) for j in range(-2000, 2000, 500)]
    got = G.common_clipped_areas(pa.array(squares, G.ARROW_POLYGONS), np.array([[7.0, 3.0, 400.0, -300.0]] * len(squares)), r)
    assert got.sum() == pytest.approx(abs(G.area(G.clip(G.footprint(7, 3, r), G.footprint(400, -300, r)))), rel=1e-12)


def test_holes_rings_and_edges(spark):
    g = [{"outer": box(0, 0, 4, 4), "holes": [box(1, 1, 2, 2)]}]
    assert G.clipped_areas(pa.array([g, None, [], g * 2], G.ARROW_POLYGONS), np.full(4, 2.0), np.full(4, 2.0), 50.0).tolist() == pytest.approx([15.0, 0, 0, 30.0])
    assert G.covers(g, 3, 3) and G.covers(g, 1, 1.5) and not G.covers(g, 1.5, 1.5) and G.covers(g, 4, 4) and not G.covers(g, 5, 1)
    d = spark.createDataFrame([(g,)], f"polygons {G.POLYGONS}")
    r = d.select(G.ring_area(F.col("polygons")[0]["outer"]).alias("a"), G.box(F.col("polygons")).alias("b"), F.size(G.edges(F.col("polygons"))).alias("n")).first()
    assert r.a == -16.0 and (r.b.x0, r.b.y1) == (0.0, 4.0) and r.n == 8
    t = tracts(spark, (0, 0, 1, 1), (1, 0, 2, 1))
    assert spatial.market_boundary(t).count() == 6


def test_overlaps_make_no_row_for_each_pair(spark, monkeypatch):
    """Blocks of 20 contexts and pieces of an odd edge, by all pairs: two crowds, a hole, a slanted tract, contexts at one place and one alone."""
    rng = np.random.default_rng(3)
    hole = [{"outer": box(-R, -R, 2 * R, 2 * R), "holes": [box(0, 0, 900, 700)]}]
    slanted = [{"outer": ring_of(np.array([(2.0 * R, -R), (5 * R, 0), (4 * R, 2 * R), (2 * R, R)])), "holes": []}]
    t = spark.createDataFrame([("m", "00000000000", hole), ("m", "00000000001", slanted)], TRACTS)
    at = [*rng.normal((0.3 * R, 0.2 * R), 0.6 * R, (70, 2)), *rng.normal((3 * R, 0.5 * R), 0.5 * R, (30, 2)), *[(100.0, 50.0)] * 3, (90 * R, 0)]
    c = contexts(spark, *at)
    index = spatial.clip_index(c, t)
    pairs = [tuple(r) for r in spatial.jaccard_pairs(index, t).collect()]
    near = {f"c{i}": [j for a, b, j in pairs if f"c{i}" in (a, b)] for i in range(len(at))}

    def never(*_):
        raise AssertionError("rows by pairs")

    monkeypatch.setattr(spatial, "pair_bounds", never)
    told, links = spatial.overlap(c, index, t, block=20, edge=1300.0)
    for r in told.collect():
        j = near[r.context_instance_id]
        assert r.geometric_jaccard == pytest.approx(max(j, default=0.0), abs=1e-9) and r.threshold_neighbor_count == sum(x >= spatial.JACCARD_STRESS for x in j)
    parts = {tuple(sorted(g)) for g in groups_of([f"c{i}" for i in range(len(at))], [(a, b) for a, b, j in pairs if j >= spatial.JACCARD_STRESS])}
    assert {tuple(sorted(g)) for g in groups_of([f"c{i}" for i in range(len(at))], [(r.a, r.b) for r in links.collect()])} == parts
    assert links.count() < len(pairs)


def groups_of(names, links):
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    return [[n for n in names if find(n) == r] for r in names if root[r] == r]
