"""Planar geometry on arrays of points: native columns where an expression says it, numpy in Arrow functions otherwise.

A polygon is struct<outer: array<struct<x, y>>, holes: array<array<struct<x, y>>>>, rings closed or not. A footprint
is the regular polygon of a buffer, SIDES vertices on the circle. Clipping is against convex windows only; the area of
a clipped ring keeps its sign, so holes subtract.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = 256  # 64 segments a quadrant
EDGES_AT_ONCE = 2048  # a matrix of so many edges by SIDES
RING = "array<struct<x:double,y:double>>"
POLYGON = f"struct<outer:{RING},holes:array<{RING}>>"
POLYGONS = f"array<{POLYGON}>"


def ring_area(ring: Column) -> Column:
    """Signed shoelace area: positive counter-clockwise."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, after, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.aggregate(cross, F.lit(0.0), lambda s, c: s + F.coalesce(c, F.lit(0.0))) / 2


def box(polygons: Column) -> Column:
    """struct (x0, y0, x1, y1) around the outer rings."""
    points = F.flatten(F.transform(polygons, lambda p: p["outer"]))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def cells(b: Column, size: float) -> Column:
    """Grid cells (i, j) that a box touches."""
    i = F.sequence(F.floor(b["x0"] / size), F.floor(b["x1"] / size))
    j = F.sequence(F.floor(b["y0"] / size), F.floor(b["y1"] / size))
    return F.flatten(F.transform(i, lambda a: F.transform(j, lambda c: F.struct(a.alias("i"), c.alias("j")))))


def project_polygons(polygons: Column, project) -> Column:
    """Every vertex through project(x, y)."""
    ring = lambda r: F.transform(r, lambda p: project(p["x"], p["y"]))
    return F.transform(polygons, lambda g: F.struct(ring(g["outer"]).alias("outer"), F.transform(g["holes"], ring).alias("holes")))


def edges(polygons: Column) -> Column:
    """Undirected edges of all rings as struct (a, b), a before b."""

    def of(ring: Column) -> Column:
        pairs = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))
        return F.filter(pairs, lambda e: e["a"] != e["b"])

    return F.flatten(F.transform(polygons, lambda g: F.concat(of(g["outer"]), F.flatten(F.transform(g["holes"], of)))))


def segment_distance(x: Column, y: Column, a: Column, b: Column) -> Column:
    """Distance of a point from a segment."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - a["x"]) * dx + (y - a["y"]) * dy) / (dx * dx + dy * dy)))
    return F.hypot(x - a["x"] - t * dx, y - a["y"] - t * dy)


def footprint(x: float, y: float, radius: float) -> np.ndarray:
    t = 2 * math.pi * np.arange(SIDES) / SIDES
    return np.column_stack([x + radius * np.cos(t), y + radius * np.sin(t)])


def footprint_area(radius: float) -> float:
    return SIDES / 2 * radius * radius * math.sin(2 * math.pi / SIDES)


def as_ring(points: list[dict]) -> np.ndarray:
    r = np.array([(p["x"], p["y"]) for p in points], dtype=np.float64).reshape(-1, 2)
    return r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r


def area(r: np.ndarray) -> float:
    if len(r) < 3:
        return 0.0
    x, y = (r - r[0]).T
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def clip(ring: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Part of a simple ring inside a convex counter-clockwise window, half-plane by half-plane.

    Half-planes that hold all vertices cut nothing and are passed over.
    """
    if not len(ring):
        return ring
    after = np.roll(window, -1, axis=0)
    d = after - window
    cutting = (d[:, :1] * (ring[:, 1] - window[:, 1:]) - d[:, 1:] * (ring[:, 0] - window[:, :1]) < 0).any(axis=1)
    for a, b in zip(window[cutting], after[cutting], strict=True):
        side = (b[0] - a[0]) * (ring[:, 1] - a[1]) - (b[1] - a[1]) * (ring[:, 0] - a[0])
        inside = side >= 0
        if not inside.any():
            return ring[:0]
        if inside.all():
            continue
        nxt, side_nxt, inside_nxt = np.roll(ring, -1, axis=0), np.roll(side, -1), np.roll(inside, -1)
        crossing = inside != inside_nxt
        with np.errstate(divide="ignore", invalid="ignore"):
            t = side / (side - side_nxt)
        cut = ring + np.where(crossing, t, 0.0)[:, None] * (nxt - ring)
        # Each vertex gives itself if inside, then the crossing of its edge if there is one.
        both = np.stack([ring, cut], axis=1).reshape(-1, 2)
        ring = both[np.stack([inside, crossing], axis=1).reshape(-1)]
    return ring


class Window:
    """A convex counter-clockwise polygon seen from a point within it: its area by angle."""

    def __init__(self, vertices: np.ndarray) -> None:
        self.centre = vertices.mean(axis=0)
        w = vertices - self.centre
        angle = np.arctan2(w[:, 1], w[:, 0])
        k = int(np.argmin(angle))
        self.w, self.angle = np.roll(w, -k, axis=0), np.roll(angle, -k)
        self.next = np.roll(self.w, -1, axis=0)
        parts = (self.w[:, 0] * self.next[:, 1] - self.w[:, 1] * self.next[:, 0]) / 2
        self.before = np.concatenate(([0.0], np.cumsum(parts)))
        self.area = float(self.before[-1])
        edge = self.next - self.w
        self.normal, self.offset = np.column_stack([edge[:, 1], -edge[:, 0]]), edge[:, 1] * self.w[:, 0] - edge[:, 0] * self.w[:, 1]

    def swept(self, angle: np.ndarray) -> np.ndarray:
        """Area from the first vertex on to an angle, beyond a whole turn too."""
        turns = np.floor((angle - self.angle[0]) / (2 * np.pi))
        inner = angle - 2 * np.pi * turns
        k = np.clip(np.searchsorted(self.angle, inner, side="right") - 1, 0, len(self.w) - 1)
        d = np.column_stack([np.cos(inner), np.sin(inner)])
        v, e = self.w[k], self.next[k] - self.w[k]
        with np.errstate(divide="ignore", invalid="ignore"):
            r = (v[:, 0] * e[:, 1] - v[:, 1] * e[:, 0]) / (d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0])
        p = d * r[:, None]
        return turns * self.area + self.before[k] + (v[:, 0] * p[:, 1] - v[:, 1] * p[:, 0]) / 2

    def sector(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Signed area of the window between the directions of a and b, the short way round."""
        start = np.arctan2(a[:, 1], a[:, 0])
        turn = np.arctan2(a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0], (a * b).sum(axis=1))
        return self.swept(start + turn) - self.swept(start)

    def split(self, a: np.ndarray, b: np.ndarray):
        """For edges (a, b) seen from the centre the ends p, q of the part inside, and whether there is none.

        An edge is inside where normal . (a + t d) <= offset for all sides. An edge outside has p = q = b.
        """
        d = b - a
        ahead, room = d @ self.normal.T, self.offset - a @ self.normal.T
        with np.errstate(divide="ignore", invalid="ignore"):
            t = room / ahead
        start = np.where(ahead < 0, t, 0.0).max(axis=1, initial=0.0)
        end = np.where(ahead > 0, t, 1.0).min(axis=1, initial=1.0)
        outside = (start >= end) | ((ahead == 0) & (room < 0)).any(axis=1)
        start, end = np.where(outside, 1.0, np.minimum(start, 1.0)), np.where(outside, 1.0, np.maximum(end, 0.0))
        p, q = a + start[:, None] * d, a + end[:, None] * d
        p[outside], q[outside] = b[outside], b[outside]
        return p, q, start, end, outside

    def edge_areas(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What each edge, seen from the centre, adds to the area of its ring inside the window: an edge spans a triangle with
        the centre, of which the part of the edge inside counts as it is, and what lies beyond as the window's sector."""
        out = np.zeros(len(a))
        for k in range(0, len(a), EDGES_AT_ONCE):
            x, y = a[k : k + EDGES_AT_ONCE], b[k : k + EDGES_AT_ONCE]
            p, q, start, end, outside = self.split(x, y)
            inside = (p[:, 0] * q[:, 1] - p[:, 1] * q[:, 0]) / 2
            beyond = np.where(start > 0, self.sector(x, p), 0.0) + np.where(~outside & (end < 1), self.sector(q, y), 0.0)
            out[k : k + EDGES_AT_ONCE] = np.where(outside, 0.0, inside) + beyond
        return out

    def ring_area(self, ring: np.ndarray) -> float:
        """Signed area of a simple ring inside the window."""
        a = ring - self.centre
        return float(self.edge_areas(a, np.roll(a, -1, axis=0)).sum()) if len(ring) > 2 else 0.0


class Rings:
    """The rings of a batch of polygon lists as flat arrays: edges a to b, the ring of each edge, the row and sign of each ring."""

    def __init__(self, batch: pa.Array) -> None:
        parts, row = batch.flatten(), pc.list_parent_indices(batch).to_numpy()
        outer, holes = pc.struct_field(parts, "outer"), pc.struct_field(parts, "holes")
        inner, of_part = holes.flatten(), pc.list_parent_indices(holes).to_numpy()
        at, ring = [], []
        for lists, first in ((outer, 0), (inner, len(parts))):
            points = lists.flatten()
            at.append(np.column_stack([pc.struct_field(points, c).to_numpy(zero_copy_only=False) for c in "xy"]).reshape(-1, 2))
            ring.append(first + pc.list_parent_indices(lists).to_numpy())
        self.a, self.ring = np.concatenate(at), np.concatenate(ring)
        self.row, self.sign = np.concatenate([row, row[of_part]]), np.concatenate([np.ones(len(parts)), -np.ones(len(inner))])
        # The point after each one; after a ring's last comes its first.
        after = np.arange(1, len(self.a) + 1)
        first = np.flatnonzero(np.diff(self.ring, prepend=-1))
        after[np.append(first[1:], len(self.a)) - 1] = first
        self.b = self.a[after]

    def areas(self, edge_areas: np.ndarray, rows: int, edges: np.ndarray | slice = slice(None)) -> np.ndarray:
        """By row, from what each of the edges adds; below a millionth of a square metre it is rounding."""
        by_ring = np.abs(np.bincount(self.ring[edges], edge_areas, minlength=len(self.row)))
        total = np.bincount(self.row, by_ring * self.sign, minlength=rows)
        return np.where(total > 1e-6, total, 0.0)


def covers(polygons: list[dict], x: float, y: float) -> bool:
    """Whether the point is in a polygon or on its boundary, holes' boundaries included."""
    for g in polygons:
        place = [locate(as_ring(r), x, y) for r in [g["outer"], *(g["holes"] or ())]]
        if 0 in place or (place[0] > 0 and not any(p > 0 for p in place[1:])):
            return True
    return False


def locate(r: np.ndarray, x: float, y: float) -> int:
    """1 inside a ring, 0 on it, -1 outside."""
    if not len(r):
        return -1
    a, b = r, np.roll(r, -1, axis=0)
    cross = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
    within = (np.minimum(a[:, 0], b[:, 0]) <= x) & (x <= np.maximum(a[:, 0], b[:, 0])) & (np.minimum(a[:, 1], b[:, 1]) <= y) & (y <= np.maximum(a[:, 1], b[:, 1]))
    if ((cross == 0) & within).any():
        return 0
    up = (a[:, 1] <= y) & (b[:, 1] > y) & (cross > 0)
    down = (a[:, 1] > y) & (b[:, 1] <= y) & (cross < 0)
    return 1 if (int(up.sum()) - int(down.sum())) else -1


def covers_column(polygons: Column, x: Column, y: Column) -> Column:
    @F.arrow_udf("boolean")
    def of(g: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
        return pa.array([covers(p, a, b) if None not in (p, a, b) else None for p, a, b in zip(g.to_pylist(), xs.to_pylist(), ys.to_pylist(), strict=True)], type=pa.bool_())

    return of(polygons, x, y)


ARROW_RING = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
ARROW_POLYGONS = pa.list_(pa.struct([("outer", ARROW_RING), ("holes", pa.list_(ARROW_RING))]))


def clipped_areas(batch: pa.Array, xs: np.ndarray, ys: np.ndarray, radius: float) -> np.ndarray:
    """Area of each row's polygons inside the footprint at its point: one window for all, as rings are seen from their point."""
    rings, centre = Rings(batch), np.column_stack([xs, ys])
    own = centre[rings.row[rings.ring]] if len(rings.ring) else np.zeros((0, 2))
    return rings.areas(Window(footprint(0.0, 0.0, radius)).edge_areas(rings.a - own, rings.b - own), len(batch))


def footprint_clip_area(polygons: Column, x: Column, y: Column, radius: float) -> Column:
    """Area of polygons inside the footprint at (x, y)."""

    @F.arrow_udf("double")
    def of(g: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
        return pa.array(clipped_areas(g, xs.to_numpy(zero_copy_only=False), ys.to_numpy(zero_copy_only=False), radius))

    return of(polygons, x, y)


def common_window(shift: np.ndarray, radius: float) -> Window | None:
    """The convex window that the footprint about the origin shares with the one about `shift`, None if there is none.

    A footprint is its own image through its centre, so the window is its own through the middle of the shift: the corners of
    the first inside the second, the crossing after them, and the images of these.
    """
    ring = footprint(0.0, 0.0, radius)
    away = ring - shift
    turn = 2 * math.pi / SIDES
    from_side = np.arctan2(away[:, 1], away[:, 0]) % turn - turn / 2
    inside = np.hypot(*away.T) * np.cos(from_side) <= radius * math.cos(turn / 2)
    if inside.all() or np.hypot(*shift) < 1e-9:  # at one place rounding would decide which corners are inside
        return Window(ring)
    other = Window(footprint(0.0, 0.0, radius))
    if inside.any():
        first = int(np.flatnonzero(inside & ~np.roll(inside, 1))[0])
        run = np.roll(ring, -first, axis=0)[: int(inside.sum())]
        last, beyond = run[-1], ring[(first + len(run)) % SIDES]
        _, q, _, _, _ = other.split((last - shift)[None], (beyond - shift)[None])
        corners = np.concatenate([run, q + shift])
    else:
        # The rims cross within single sides, if at all.
        p, q, _, _, outside = other.split(away, np.roll(away, -1, axis=0))
        corners = np.concatenate([np.stack([p, q], axis=1)[~outside].reshape(-1, 2) + shift])
    c = np.concatenate([corners, shift - corners])
    c = c[np.hypot(*(c - np.roll(c, 1, axis=0)).T) > 1e-7]
    return Window(c) if len(c) > 2 else None


def common_clipped_areas(batch: pa.Array, at: np.ndarray, radius: float) -> np.ndarray:
    """Area of each row's polygons inside both footprints, at (x1, y1) and (x2, y2); one window for each pair of points."""
    rings = Rings(batch)
    own, out = at[rings.row[rings.ring]] if len(rings.ring) else np.zeros((0, 4)), np.zeros(len(batch))
    pairs, of_row = np.unique(at, axis=0, return_inverse=True)
    of_edge = of_row.reshape(-1)[rings.row[rings.ring]]
    order = np.argsort(of_edge, kind="stable")
    bounds = np.searchsorted(of_edge[order], np.arange(len(pairs) + 1))
    added = np.zeros(len(rings.a))
    for k, pair in enumerate(pairs):
        edges = order[bounds[k] : bounds[k + 1]]
        window = common_window(pair[2:] - pair[:2], radius) if len(edges) else None
        if window is not None:
            shift = own[edges, :2] + window.centre
            added[edges] = window.edge_areas(rings.a[edges] - shift, rings.b[edges] - shift)
    out += rings.areas(added, len(batch))
    return out


def common_clip_area(polygons: Column, x1: Column, y1: Column, x2: Column, y2: Column, radius: float) -> Column:
    """Area of polygons inside both footprints, at (x1, y1) and (x2, y2)."""

    @F.arrow_udf("double")
    def of(g: pa.Array, *at: pa.Array) -> pa.Array:
        return pa.array(common_clipped_areas(g, np.column_stack([c.to_numpy(zero_copy_only=False) for c in at]), radius))

    return of(polygons, x1, y1, x2, y2)
