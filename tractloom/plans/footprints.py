"""SQL that states the spatial evidence of footprints over square tracts, with nothing of the operators' own geometry.

A footprint is a regular polygon whose half width at a height is read off its side there. What footprints share with a
square is the integral over the height of how far the least right end lies beyond the largest left end; between
neighbouring corners' heights all ends are straight lines, so an interval is cut further only where two of them cross, and
trapezoids are exact.
"""

from __future__ import annotations

import math

from tractloom.functions.geometry import SIDES, footprint_area
from tractloom.operators.membership import JACCARD_STRESS, PRIMARY_RADIUS_M
from tractloom.operators.spatial import TOLERANCE

R, STEP, QUARTER = PRIMARY_RADIUS_M, 2 * math.pi / SIDES, SIDES // 4


def half_width(d: str) -> str:
    """Half the footprint's width at the height d over its middle."""
    k = f"least({QUARTER - 1}, greatest(-{QUARTER}, floor(asin(greatest(-1.0, least(1.0, ({d}) / {R}))) / {STEP!r})))"
    low, high = f"({R} * sin({STEP!r} * {k}))", f"({R} * sin({STEP!r} * ({k} + 1)))"
    return f"({R} * cos({STEP!r} * {k}) + (({d}) - {low}) / ({high} - {low}) * {R} * (cos({STEP!r} * ({k} + 1)) - cos({STEP!r} * {k})))"


def ends(y: str, n: int) -> str:
    return f"ax + {half_width(f'{y} - ay')} AS ra{n}, px + {half_width(f'{y} - py')} AS rb{n}, ax - {half_width(f'{y} - ay')} AS la{n}, px - {half_width(f'{y} - py')} AS lb{n}"


def evidence_sql(points_sql: str, half: float) -> str:
    side = 2 * half
    rights, lefts = ["ra{0}", "rb{0}", "x1"], ["la{0}", "lb{0}", "x0"]
    lines = [f"[{p.format(1)} - {q.format(1)}, {p.format(2)} - {q.format(2)}]" for i, p in enumerate(rights + lefts) for q in (rights + lefts)[i + 1 :]]
    at = lambda line: line if "{0}" not in line else f"({line.format(1)} + t * ({line.format(2)} - {line.format(1)}))"
    gap = f"greatest(0.0, least({', '.join(map(at, rights))}) - greatest({', '.join(map(at, lefts))}))"
    first, last = ([f"{f}({', '.join(x.format(n) for x in xs)})" for f, xs in (("least", rights), ("greatest", lefts))] for n in (1, 2))
    same = lambda name, xs: " OR ".join(f"({x.format(1)} = {name}1 AND {x.format(2)} = {name}2)" for x in xs)
    return f"""WITH RECURSIVE {points_sql},
        sq AS (SELECT DISTINCT market_id, floor(x / {side})::BIGINT AS i, floor(y / {side})::BIGINT AS j FROM pts),
        corners AS (SELECT list({R} * sin({STEP!r} * k)) AS s FROM range(-{QUARTER}, {QUARTER} + 1) t(k)),
        pr AS (SELECT a.market_id, a.vec_id AS l, b.vec_id AS r, a.x AS ax, a.y AS ay, b.x AS px, b.y AS py FROM pts a JOIN pts b ON a.market_id = b.market_id AND a.vec_id <= b.vec_id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) < {4 * R * R}),
        met AS (SELECT l, r, ax, ay, px, py, i, j, i * {side} AS x0, (i + 1) * {side} AS x1, greatest(j * {side}, ay - {R}, py - {R}) AS lo, least((j + 1) * {side}, ay + {R}, py + {R}) AS hi FROM pr JOIN sq USING (market_id)
                WHERE greatest(j * {side}, ay - {R}, py - {R}) < least((j + 1) * {side}, ay + {R}, py + {R}) AND greatest(i * {side}, ax - {R}, px - {R}) < least((i + 1) * {side}, ax + {R}, px + {R})),
        heights AS (SELECT met.*, list_sort(list_concat([lo, hi], list_filter(list_concat(list_transform(s, lambda q: ay + q), CASE WHEN l = r THEN [] ELSE list_transform(s, lambda q: py + q) END), lambda y: y > lo AND y < hi))) AS ys FROM met, corners),
        spans AS (SELECT l, r, i, j, ax, ay, px, py, x0, x1, unnest(ys[:-2]) AS y1, unnest(ys[2:]) AS y2 FROM heights),
        straight AS (SELECT l, r, i, j, x0, x1, y2 - y1 AS h, {ends("y1", 1)}, {ends("y2", 2)} FROM spans WHERE y2 > y1),
        judged AS (SELECT *, {first[0]} AS right1, {first[1]} AS left1, {last[0]} AS right2, {last[1]} AS left2 FROM straight),
        told AS (SELECT *, CASE WHEN right1 <= left1 AND right2 <= left2 AND ({same("right", rights)}) AND ({same("left", lefts)}) THEN 0.0
                                WHEN right1 >= left1 AND right2 >= left2 AND ({same("right", rights)}) AND ({same("left", lefts)}) THEN h * (right1 - left1 + right2 - left2) / 2 END AS part FROM judged),
        cut AS (SELECT l, r, i, j, h, ra1, ra2, rb1, rb2, la1, la2, lb1, lb2, x0, x1,
                       list_sort(list_concat([0.0::DOUBLE, 1.0::DOUBLE], list_filter(list_transform([{", ".join(lines)}], lambda d: d[1] / nullif(d[1] - d[2], 0)), lambda t: t > 0 AND t < 1))) AS ts FROM told WHERE part IS NULL),
        fine AS (SELECT l, r, i, j, h, ts, list_transform(ts, lambda t: {gap}) AS g FROM cut),
        parts AS (SELECT l, r, i, j, part FROM told WHERE part IS NOT NULL UNION ALL
                  SELECT l, r, i, j, h * list_sum(list_transform(range(1, len(ts)), lambda k: (ts[k + 1] - ts[k]) * (g[k] + g[k + 1]) / 2)) FROM fine),
        squares AS (SELECT l, r, i, j, sum(part) AS a FROM parts GROUP BY ALL HAVING sum(part) > 1e-6),
        areas AS (SELECT l, r, sum(a) AS a, count(*) AS n FROM squares GROUP BY ALL),
        own AS (SELECT p.vec_id, p.market_id, p.x, p.y, least(coalesce(a.a, 0), {footprint_area(R)!r}) AS a, coalesce(a.n, 0) AS n FROM pts p LEFT JOIN areas a ON a.l = p.vec_id AND a.r = p.vec_id),
        jac AS (SELECT s.l, s.r, least(s.a, x.a + y.a - s.a) / (x.a + y.a - s.a) AS j FROM areas s JOIN areas x ON x.l = s.l AND x.r = s.l JOIN areas y ON y.l = s.r AND y.r = s.r WHERE s.l < s.r),
        sides AS (SELECT l AS vec_id, r AS other, j FROM jac UNION ALL SELECT r, l, j FROM jac),
        best AS (SELECT vec_id, max(j) AS j, count(*) FILTER (WHERE j >= {JACCARD_STRESS}) AS n FROM sides GROUP BY vec_id),
        links AS (SELECT vec_id, other FROM sides WHERE j >= {JACCARD_STRESS}),
        reach AS (SELECT vec_id AS v, vec_id AS root FROM pts UNION SELECT e.other, w.root FROM reach w JOIN links e ON e.vec_id = w.v),
        comp AS (SELECT v, min(root) AS root FROM reach GROUP BY v),
        named AS (SELECT root, count(*) AS size, 'geo02_spatial_component:sha256:' || sha256('["' || string_agg('ctx-' || v, '","' ORDER BY 'ctx-' || v) || '"]') AS id FROM comp GROUP BY root),
        rims AS (SELECT market_id, unnest([{{'x0': i, 'y0': j, 'x1': i + 1, 'y1': j}}, {{'x0': i, 'y0': j + 1, 'x1': i + 1, 'y1': j + 1}}, {{'x0': i, 'y0': j, 'x1': i, 'y1': j + 1}}, {{'x0': i + 1, 'y0': j, 'x1': i + 1, 'y1': j + 1}}]) AS e FROM sq),
        rim AS (SELECT market_id, e FROM rims GROUP BY ALL HAVING count(*) = 1),
        dist AS (SELECT vec_id, min(sqrt(pow(greatest(e.x0 * {side} - x, x - e.x1 * {side}, 0), 2) + pow(greatest(e.y0 * {side} - y, y - e.y1 * {side}, 0), 2))) AS d FROM pts JOIN rim USING (market_id) GROUP BY vec_id)
        SELECT 'ctx-' || o.vec_id AS context_instance_id, o.market_id, round(CASE WHEN {footprint_area(R)!r} - o.a > {TOLERANCE * footprint_area(R)!r} THEN o.a / {footprint_area(R)!r} ELSE 1.0 END, 9) AS geometric_completeness,
               CASE WHEN {footprint_area(R)!r} - o.a > {TOLERANCE * footprint_area(R)!r} THEN 'truncated' ELSE 'not_truncated' END AS market_edge_state, o.n AS positive_area_tract_count, round(d.d, 6) AS anchor_to_market_boundary_m,
               round(coalesce(b.j, 0), 8) AS geometric_jaccard, coalesce(b.n, 0) AS threshold_neighbor_count, c.id AS component_id, c.size AS component_size, coalesce(b.j, 0) >= {JACCARD_STRESS} AS jaccard_dependence_stress
        FROM own o LEFT JOIN best b USING (vec_id) JOIN comp m ON m.v = o.vec_id JOIN named c USING (root) LEFT JOIN dist d ON d.vec_id = o.vec_id"""
