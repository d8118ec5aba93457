import numpy as np
import pyarrow as pa
import pytest

from test_spatial import CONTEXTS, TRACTS, R, box, ring_of
from tractloom.functions import geometry as G
from tractloom.operators import rims, spatial

SHAPES = [
    [{"outer": box(-R, -R, 2 * R, 2 * R), "holes": [box(0, 0, 900, 700)]}],
    [{"outer": ring_of(np.array([(2.0 * R, -R), (5 * R, 0), (4 * R, 2 * R), (2 * R, R)])), "holes": []}],
    [{"outer": box(-8000, 2 * R, 0, 30000), "holes": []}],
    [{"outer": box(0, 2 * R, 8000, 30000)[::-1], "holes": []}],
    [{"outer": box(-3000, -20000, -2900, -R), "holes": None}],
]


@pytest.mark.parametrize("away", [(0.0, 0.0), (654321.5, -1234567.25)])
def test_shared_areas_equal_clipping(away):
    """Holes, slanted and turned rings, tracts that share part of a side; contexts on corners and sides, hardly apart, about two radii apart and at one place."""
    rng = np.random.default_rng(1)
    moved = lambda ring: [{"x": p["x"] + away[0], "y": p["y"] + away[1]} for p in ring]
    tracts = pa.array([[{"outer": moved(g["outer"]), "holes": g["holes"] and [moved(h) for h in g["holes"]]} for g in t] for t in SHAPES], G.ARROW_POLYGONS)
    odd = [(0, 0), (0, 0), (1e-7, 0), (0, 1e-5), (50, 0), (150, 1e-3), (8000, 0), (900, 700), (R, 0), (2 * R, 0), (2 * R - 1e-6, 0), (90 * R, 0)]
    at = np.concatenate([rng.normal((0.3 * R, 0.2 * R), 0.9 * R, (12, 2)), rng.normal((3 * R, 0.5 * R), 0.6 * R, (6, 2)), rng.normal((0, 2 * R), 0.4 * R, (6, 2)), odd]) + away
    own = pa.table({"no": np.arange(len(at)), "anchor_x_m": at[:, 0], "anchor_y_m": at[:, 1], "size": np.ones(len(at))})
    made = rims.prepared(own, tracts, R)
    for c in ("touched", "base", "jumps"):
        own = own.append_column(c, made[c])
    edges = rims.common_edges(own, own)
    r = rims.Rims(own, edges, at[0], R)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(at)), np.arange(len(at))))
    got = rims.shared_areas(r, i, r, j, edges, at[0], R)
    want = [G.common_clipped_areas(tracts, np.array([[*at[a], *at[b]]] * len(tracts)), R).sum() for a, b in zip(i, j, strict=True)]
    assert got == pytest.approx(np.array(want), abs=1e-4) and (np.array(want) > 0).sum() > 600


def test_contexts_at_one_place_share_all(spark, monkeypatch):
    """Also no polygon is clipped for a pair."""

    def never(*_):
        raise AssertionError("clipped by pairs")

    monkeypatch.setattr(spatial, "shared_areas", never)
    t = spark.createDataFrame([("m", f"{k}", g) for k, g in enumerate(SHAPES)], TRACTS)
    c = spark.createDataFrame([(f"c{k}", "s", "m", float(x), float(y)) for k, (x, y) in enumerate([(100, 50)] * 3 + [(4 * R, 100), (4 * R, 4 * R), (90 * R, 0)])], CONTEXTS)
    told = {r[0]: r[1:] for r in spatial.overlap(c, spatial.clip_index(c, t), t)[0].collect()}
    assert [told[f"c{k}"] for k in range(3)] == [(pytest.approx(1.0, abs=1e-12), 2)] * 3
    assert told["c3"][1] == 0 and told["c5"] == (0.0, 0)
