"""What the footprints of many pairs of contexts share of the tracts, exactly and without a polygon for each pair.

The shared area is an integral along its boundary, which has three parts: what of either rim lies in the other footprint, and what of the
tracts' edges lies in both. Along its own rim a context keeps how many tracts (0 or 1, as they are disjoint) lie there, as jumps; of an
edge it keeps the stretch within its footprint. A pair then needs the two places where its rims cross, a difference of sums along
each rim, and the overlaps of stretches: no clipping.

Footprints are one regular polygon P moved about. A place on P is a number: the side, counted counter-clockwise from angle 0, plus
the share of that side before the place.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tractloom.functions import geometry as G

N, STEP = G.SIDES, 2 * math.pi / G.SIDES
TOUCHED = "array<struct<x:double,y:double,dx:double,dy:double,n:double,start:double,end:double>>"
JUMPS = "array<struct<at:double,n:double>>"
AT_ONCE = 1_000_000  # numbers of a matrix that is held at a time
NEWTON = 12  # steps at most; the width is made of straight pieces, so two or three do


def net_edges(polygons: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges a to b with the tracts to their left, and how often each counts: what one tract has and its neighbour has the other way round is gone."""
    rings = G.Rings(polygons)
    around = np.bincount(rings.ring, (rings.a[:, 0] - rings.a[0, 0]) * (rings.b[:, 1] - rings.a[0, 1]) - (rings.a[:, 1] - rings.a[0, 1]) * (rings.b[:, 0] - rings.a[0, 0]), minlength=len(rings.row)) if len(rings.a) else np.zeros(0)
    turned = (around * rings.sign < 0)[rings.ring]
    ends = np.column_stack([np.where(turned[:, None], rings.b, rings.a), np.where(turned[:, None], rings.a, rings.b)])
    ends = ends[(ends[:, :2] != ends[:, 2:]).any(axis=1)]
    forth = (ends[:, 0] < ends[:, 2]) | ((ends[:, 0] == ends[:, 2]) & (ends[:, 1] < ends[:, 3]))
    named, of = np.unique(np.where(forth[:, None], ends, ends[:, [2, 3, 0, 1]]), axis=0, return_inverse=True)
    n = np.bincount(of.ravel(), np.where(forth, 1.0, -1.0), minlength=len(named))
    return named[n != 0][:, :2], named[n != 0][:, 2:], n[n != 0]


def place_of(points: np.ndarray) -> np.ndarray:
    """The place on P in the direction of each point."""
    turn = np.arctan2(points[:, 1], points[:, 0]) / STEP % N
    side = np.floor(turn)
    # Along a side the share is that of the heights over the ray to the side's first corner.
    over = (turn - side) * STEP
    return (side + np.sin(over) / (np.sin(over) + np.sin(STEP - over))) % N


def prepared(contexts: pa.Table, polygons: pa.Array, radius: float) -> pa.Table:
    """For contexts (no, anchor_x_m, anchor_y_m) of one block and the tracts that they touch: no, the edges touched and the rim."""
    a, b, n = net_edges(polygons)
    at = np.column_stack([contexts["anchor_x_m"].to_numpy(), contexts["anchor_y_m"].to_numpy()])
    window, d = G.Window(G.footprint(0.0, 0.0, radius)), b - a
    touched: list[list[np.ndarray]] = [[np.zeros((0, 7))], [np.zeros(0, np.int64)]]
    jumps: list[list[np.ndarray]] = [[np.zeros((0, 2))], [np.zeros(0, np.int64)]]
    base = np.zeros(len(at))

    for first in range(0, len(at) if len(a) else 0, max(1, AT_ONCE // (8 * max(1, len(a))))):
        rows = np.arange(first, min(len(at), first + max(1, AT_ONCE // (8 * len(a)))))
        row, edge = np.repeat(rows, len(a)), np.tile(np.arange(len(a)), len(rows))
        p, q = a[edge] - at[row], b[edge] - at[row]
        t = np.clip(-(p * d[edge]).sum(axis=1) / (d[edge] ** 2).sum(axis=1), 0.0, 1.0)
        near = np.flatnonzero(np.hypot(*(p + t[:, None] * d[edge]).T) < radius)
        start, end, out = np.ones(len(row)), np.ones(len(row)), np.ones(len(row), bool)
        for k in range(0, len(near), G.EDGES_AT_ONCE):
            these = near[k : k + G.EDGES_AT_ONCE]
            _, _, start[these], end[these], out[these] = window.split(p[these], q[these])
        ins = ~out
        touched[0].append(np.column_stack([a[edge[ins]], d[edge[ins]], n[edge[ins]], start[ins], end[ins]]))
        touched[1].append(row[ins])
        # What of an edge lies beyond the rim covers it as seen from the middle, counted by the way it turns.
        enters, leaves = out | (start > 0), ins & (end < 1)
        into, from_ = p + start[:, None] * d[edge], p + end[:, None] * d[edge]
        into[out] = q[out]
        corners = [place_of(x) for x in (p, q)]
        for some, x, y in ((enters, corners[0][enters], np.where(out, corners[1], place_of(into))[enters]), (leaves, place_of(from_[leaves]), corners[1][leaves])):
            way = (y - x + N / 2) % N - N / 2
            weight, whose = n[edge[some]], row[some]
            over = np.where(way > 0, np.where(y < x, 1.0, 0.0), np.where(y > x, -1.0, 0.0)) * weight
            base += np.bincount(whose, over, minlength=len(at))
            jumps[0] += [np.column_stack([x, weight]), np.column_stack([y, -weight])]
            jumps[1] += [whose, whose]

    def lists(parts: list[list[np.ndarray]], names: list[str]) -> pa.Array:
        values, whose = np.concatenate(parts[0]), np.concatenate(parts[1])
        order = np.argsort(whose, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(at)))]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(c) for c in values[order].T.copy()], names))

    # Jumps at one place are one, those of two edges that meet in a corner none.
    places, whose = np.concatenate(jumps[0]), np.concatenate(jumps[1])
    order = np.lexsort((places[:, 0], whose))
    places, whose = places[order], whose[order]
    if len(whose):
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(whose) != 0) | (np.diff(places[:, 0]) != 0)]))
        total = np.add.reduceat(places[:, 1], heads)
        heads, total = heads[total != 0], total[total != 0]
        places, whose = np.column_stack([places[heads, 0], total]), whose[heads]
    edges, rim = lists(touched, ["x", "y", "dx", "dy", "n", "start", "end"]), lists([[places], [whose]], ["at", "n"])
    return pa.table({"no": contexts["no"], "touched": edges, "base": base, "jumps": rim})


PREPARED = f"no bigint, touched {TOUCHED}, base double, jumps {JUMPS}"


def padded(lists: pa.Array, fields: list[str], fill: list[float], width: int) -> list[np.ndarray]:
    """A matrix for each field of lists of structs, a row for each list."""
    row, flat = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
    column = np.arange(len(row)) - np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))])[row]
    out = []
    for name, rest in zip(fields, fill, strict=True):
        m = np.full((len(lists), width), rest)
        m[row, column] = pc.struct_field(flat, name).to_numpy(zero_copy_only=False)
        out.append(m)
    return out


class Rims:
    """Contexts as places, stretches of edges (start and end, one column an edge) and sums along their rims."""

    def __init__(self, t: pa.Table, edges: np.ndarray, origin: np.ndarray, radius: float) -> None:
        self.no, self.size = t["no"].to_numpy(), t["size"].to_numpy()
        self.at = np.column_stack([t["anchor_x_m"].to_numpy(), t["anchor_y_m"].to_numpy()]) - origin
        self.start, self.end = np.ones((len(t), len(edges))), np.zeros((len(t), len(edges)))
        lists = t["touched"].combine_chunks()
        own = touched_edges(lists)
        _, of = np.unique(np.concatenate([edges, own]), axis=0, return_inverse=True)
        of = of.ravel()
        column = np.full(of.max(initial=-1) + 1, -1)
        column[of[: len(edges)]] = np.arange(len(edges))
        row, column = pc.list_parent_indices(lists).to_numpy(), column[of[len(edges) :]]
        known = column >= 0
        for m, name in ((self.start, "start"), (self.end, "end")):
            m[row[known], column[known]] = pc.struct_field(lists.flatten(), name).to_numpy(zero_copy_only=False)[known]
        self.sums(t["jumps"].combine_chunks(), t["base"].to_numpy(), radius)

    def sums(self, jumps: pa.Array, base: np.ndarray, radius: float) -> None:
        """Tables of what lies along the rim from place 0 on: `knots` has all corners and jumps in order."""
        width = int(pc.max(pc.list_value_length(jumps)).as_py() or 0) if len(jumps) else 0
        at, n = padded(jumps, ["at", "n"], [float(N), 0.0], width)
        knots = np.concatenate([np.broadcast_to(np.arange(N + 1.0), (len(base), N + 1)), at], axis=1)
        order = np.argsort(knots, axis=1, kind="stable")
        knots = np.take_along_axis(knots, order, axis=1)
        here = base[:, None] + np.cumsum(np.take_along_axis(np.concatenate([np.zeros((len(base), N + 1)), n], axis=1), order, axis=1), axis=1)
        self.side = np.minimum(knots, N - 1).astype(np.int64)
        corner = G.footprint(0.0, 0.0, radius)
        along = np.roll(corner, -1, axis=0) - corner
        step = np.diff(knots, axis=1) * here[:, :-1]
        whole = lambda by: np.concatenate([np.zeros((len(base), 1)), np.cumsum(step * by, axis=1)], axis=1)
        self.along, self.table = along, np.stack([whole(1.0), whole(along[self.side[:, :-1], 0]), whole(along[self.side[:, :-1], 1])], axis=2)
        self.knots, self.here = knots, here
        self.flat = (knots + (N + 1.0) * np.arange(len(base))[:, None]).ravel()

    def until(self, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The share of the rim in tracts from place 0 to `place`, in sides, and the way made along it (x, y)."""
        i = np.searchsorted(self.flat, place + (N + 1.0) * rows, side="right") - 1
        i = i - rows * self.knots.shape[1]
        more = (place - self.knots[rows, i]) * self.here[rows, i]
        return self.table[rows, i] + more[:, None] * np.column_stack([np.ones(len(rows)), self.along[self.side[rows, i]]])

    def arc(self, rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Those from place to place, counter-clockwise."""
        return self.until(rows, last) - self.until(rows, first) + np.where((last < first)[:, None], self.table[rows, -1], 0.0)


def touched_edges(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten()
    return np.column_stack([pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("x", "y", "dx", "dy", "n")]).reshape(-1, 5)


def common_edges(a: pa.Table, b: pa.Table) -> np.ndarray:
    """x, y, dx, dy and count of the edges that contexts of both sides touch."""
    one, other = (np.unique(touched_edges(t["touched"].combine_chunks()), axis=0) for t in (a, b))
    if a is b:
        return one
    both, n = np.unique(np.concatenate([one, other]), axis=0, return_counts=True)
    return both[n == 2]


def crossings(d: np.ndarray, way: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Where the rims of P and of P moved by d in the direction `way` cross, to the left of that way: the place on the first and
    on the second one. Opposite to them on the other rim is the other crossing, as P is its own image through its middle.

    It is as high over the way as P is d wide, and the width falls from the middle to the top along straight pieces: Newton's
    steps from above stay above.
    """
    corner = G.footprint(0.0, 0.0, radius)
    c, s = np.cos(way), np.sin(way)
    peak = (way + math.pi / 2) / STEP
    top = radius * np.cos((peak - np.round(peak)) * STEP) * (1 - 1e-12)
    height = np.minimum(np.sqrt(np.maximum(radius * radius - d * d / 4, 0.0)), top)

    def end(height: np.ndarray, right: bool):
        """The side at a height, where on it, how far out, and how that changes with the height."""
        over = np.arcsin(np.clip(height / radius, -1.0, 1.0))
        side = np.floor((way + (over if right else math.pi - over)) / STEP).astype(np.int64) % N
        (x, y), (u, v) = corner[side].T, corner[(side + 1) % N].T
        x, y, u, v = x * c + y * s, y * c - x * s, u * c + v * s, v * c - u * s
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(v != y, (u - x) / (v - y), 0.0)
        return side, (x, y, u, v), x + slope * (height - y), slope

    for _ in range(NEWTON):
        (*_, far, slope_right), (*_, near, slope_left) = end(height, True), end(height, False)
        excess, fall = far - near - d, slope_right - slope_left
        with np.errstate(divide="ignore", invalid="ignore"):
            now = np.where(fall < 0, height - excess / fall, height)
        now = np.minimum(np.maximum(now, 0.0), top)
        done = np.abs(now - height) <= 1e-12 * radius
        height = now
        if done.all():
            break
    (one, at_one, far, _), (two, at_two, near, _) = end(height, True), end(height, False)
    excess = (far - near - d) / 2
    share = lambda at, out: np.clip(((out - at[0]) * (at[2] - at[0]) + (height - at[1]) * (at[3] - at[1])) / ((at[2] - at[0]) ** 2 + (at[3] - at[1]) ** 2), 0.0, 1.0)
    return (one + share(at_one, far - excess)) % N, (two + share(at_two, near + excess)) % N


def shared_areas(one: Rims, i: np.ndarray, other: Rims, j: np.ndarray, edges: np.ndarray, origin: np.ndarray, radius: float) -> np.ndarray:
    """The area of the tracts that the footprints of each pair (i, j) share."""
    out = np.zeros(len(i))
    weighed = np.zeros((0, 3))
    if len(edges):
        x, y, dx, dy = (edges[:, :4] - np.append(origin, (0.0, 0.0))).T
        weighed = np.column_stack([x * dy - y * dx, dx, dy]) * edges[:, 4:]
    at_once = max(256, AT_ONCE // (16 + len(edges)))
    for k in range(0, len(i), at_once):
        a, b = i[k : k + at_once], j[k : k + at_once]
        apart = other.at[b] - one.at[a]
        d, way, half = np.hypot(*apart.T), np.arctan2(apart[:, 1], apart[:, 0]), apart / 2
        first, second = crossings(d, way, radius)
        mine, theirs = one.arc(a, (second + N / 2) % N, first), other.arc(b, second, (first + N / 2) % N)
        twice = radius * radius * math.sin(STEP) * (mine[:, 0] + theirs[:, 0])
        move = theirs[:, 1:] - mine[:, 1:]
        twice += half[:, 0] * move[:, 1] - half[:, 1] * move[:, 0]
        if len(edges):
            both = np.maximum(np.minimum(one.end[a], other.end[b]) - np.maximum(one.start[a], other.start[b]), 0.0) @ weighed
            middle = one.at[a] + half
            twice += both[:, 0] - (middle[:, 0] * both[:, 2] - middle[:, 1] * both[:, 1])
        # An arc is at most half a rim; where footprints only just touch, rounding would make it nearly a whole one.
        meet = (d < 2 * radius) & ((first - second - N / 2) % N < 0.75 * N)
        out[k : k + at_once] = np.where(meet, np.maximum(twice / 2, 0.0), 0.0)
    return out
