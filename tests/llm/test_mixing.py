import random

import pytest
from pyspark.sql import functions as F

from tractloom.llm import mixing as M

DOCS = "doc_id long, text string, source string, size long, target int"


def water(sizes, weights=M.WEIGHTS, most=3):
    """Targets by raising the level until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = sum(w[s] for s in order if s not in capped)
        t = {s: most * sizes[s] if s in capped else rest * w[s] / share for s in order}
        over = {s for s in order if t[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return t
        capped |= over


def docs_of(spark, spec, seed=1):
    rng, rows, i = random.Random(seed), [], 0
    for source, n in spec:
        for _ in range(n):
            rows.append((i, " ".join(["w"] * rng.choice([1, 3, 20, 60])), source, 7, 7))
            i += 1
    return spark.createDataFrame(rows, DOCS)


def test_targets_and_takes(spark):
    d = docs_of(spark, [("a", 900), ("b", 20), (None, 300), ("é", 40), ("z", 300), ("c", 400)])
    m = M.mix(d, block=8).cache()
    assert m.count() == d.count()
    sizes = {r.source: r.s for r in m.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    want = water(sizes)
    for r in m.groupBy("source").agg(F.first("source_size").alias("s"), F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("got"), F.max("copies").alias("most")).collect():
        assert r.s == sizes[r.source] and r.t == pytest.approx(want[r.source])
        assert abs(r.got - r.t) <= 60 and r.most <= 3
    again = M.mix(d.repartition(7), block=8)
    assert sorted(map(tuple, m.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_unbiased(spark):
    """Over seeds every document of a source is taken as often as the source's rate says."""
    d = docs_of(spark, [("a", 30), ("b", 30)])
    runs = [M.mix(d, block=4, seed=s).select("doc_id", "copies", F.col("target") / F.col("source_size")) for s in range(12)]
    total = {}
    for r in runs:
        for i, c, rate in r.collect():
            total.setdefault(i, [0, rate])[0] += c
    assert sum(abs(c / 12 - rate) for c, rate in total.values()) / len(total) < 0.2


def test_odd_rows(spark):
    rows = [(1, None, None, 0, 0), (1, None, None, 0, 0), (None, "a b", "x", 0, 0), (2, "", "x", 0, 0), (3, "w " * 20000, "x", 0, 0), (4, "one", "y", 0, 0), (4, "one", "y", 0, 0)]
    m = M.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(m) == 7 and {r.size for r in m} == {0, 2, 20000, 1}
    assert all(0 <= r.copies <= 3 for r in m)
    assert {r.target for r in m if r.source is None} == {0.0}
    assert M.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert M.mix(spark.createDataFrame([(1, "", "a", 0, 0)], DOCS)).first().copies == 0
