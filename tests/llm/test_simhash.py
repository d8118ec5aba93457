import random

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tractloom.llm import simhash as S
from tractloom.operators.components import connected_components

DOCS = "doc_id long, text string, fp string, n_chars long"


def slow_fingerprint(text):
    words = S.WORDS.findall((text or "").encode().lower())
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(ids, fps, radius=2):
    label = list(ids)
    near = [[j for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= radius] for i in range(len(fps))]
    low = lambda xs: min((x for x in xs if x is not None), default=None)
    while True:
        new = [low(label[j] for j in n) for n in near]
        if new == label:
            return label
        label = new


def test_documents(spark):
    rng = random.Random(5)
    base = " ".join(rng.choices("the of and to in is on at".split(), k=400)).split()
    texts = [None, "", " \t", "One", "one", "a b", "A  b\n", "x" * 100000]
    for i in range(60):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(3))
        texts.append(" ".join(w))
    rows = [(i + 10, t, "clash", 0) for i, t in enumerate(texts)] + [(None, "lone text here now", "clash", 0), (None, "one", "clash", 0), (10, None, "clash", 0)]
    for block in (64, 3):
        found = S.near_duplicates(spark.createDataFrame(rows, DOCS), block=block).collect()
        want = brute([r[0] for r in rows], [slow_fingerprint(r[1]) for r in rows])
        key = lambda x: tuple((v is None, v or 0) for v in x)
        assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found), key=key) == sorted(((r[0], slow_fingerprint(r[1]), w) for r, w in zip(rows, want, strict=True)), key=key)


def test_links_equal_all_pairs(spark):
    """Random balls of fingerprints: the covering tables, and stars in crowded buckets, join just what pairs join."""
    rng = np.random.default_rng(2)
    fps = set()
    for c in rng.integers(0, 1 << 63, 12).tolist():
        for _ in range(40):
            fps.add(c ^ int(sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)).tolist()))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute(fps, fps)
    groups = {}
    for f, w in zip(signed, want, strict=True):
        groups.setdefault(w, set()).add(f)
    want_sets = {frozenset(g) for g in groups.values() if len(g) > 1}
    for block in (1, 8, 1000):
        roots = connected_components(S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), block=block)).collect()
        got = {}
        for r in roots:
            got.setdefault(r.root, set()).add(r.vertex)
        assert {frozenset(g) for g in got.values()} == want_sets


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_other_radii_link_what_pairs_link(spark, radius):
    """By pairs in small buckets and by the centres in crowded ones; beyond, the operator says no."""
    rng = np.random.default_rng(radius)
    fps = {c ^ sum(1 << int(b) for b in set(rng.integers(0, 16, radius + 2).tolist())) for c in rng.integers(0, 1 << 63, 6).tolist() for _ in range(8)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    want = dict(zip(fps, brute(fps, [f & (1 << 64) - 1 for f in fps], radius), strict=True))
    assert not radius or 6 < len(set(want.values())) < len(fps)
    for block in (1, 1000):
        roots = {r.vertex: r.root for r in connected_components(S.links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius, block)).collect()}
        assert {f: roots.get(f, f) for f in fps} == want
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([], "fp long"), S.MOST_RADIUS + 1)


@given(st.integers(0, (1 << 64) - 1), st.sets(st.integers(0, 63), max_size=2))
def test_masks_cover(x, flips):
    y = x
    for b in flips:
        y ^= 1 << b
    assert any((x ^ y) & (m & (1 << 64) - 1) == 0 for m in S.masks(2))


def test_representatives(spark):
    rows = [(3, "same text of some words", "a", 1), (7, "same text of some words", "a", 1), (3, "same text of some words", "a", 1), (9, "other words that stand alone", "b", 2), (None, "same text of some words", "c", 3), (None, "nameless only here", "d", 4), (None, "nameless only here", "d", 4)]
    kept = S.keep_representatives(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp", "n_chars"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "nameless only here"), (3, "same text of some words"), (9, "other words that stand alone")]
    assert S.keep_representatives(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (None, 3)]
    roots = {r.vertex: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots[i] == 0 for i in range(51)) and all(roots[100 + i] == 100 for i in range(40)) and 200 not in roots
    assert connected_components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).count() == 0


def test_frequent_keys_are_joined_alike(spark, monkeypatch):
    """With every key, some or none above the share that goes by broadcast."""
    rng = random.Random(8)
    texts = ["one text that a third of all rows repeats"] * 40 + ["", None, " "] * 5 + [" ".join(rng.choices("abcdefgh", k=rng.choice([3, 12]))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = []
    for hot in (1, 20, 10**9):
        monkeypatch.setattr(S, "HOT", hot)
        found.append(sorted(S.near_duplicates(docs).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts)


def test_survivor_of_a_repeated_id_does_not_depend_on_order(spark):
    rows = [(1, f"text number {k} of words", f"extra {k}") for k in range(6)] + [(2, "same text", "b"), (2, "same text", "a")]
    kept = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        some = S.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3 + seed)).collect()
        kept.add(tuple(sorted((r.doc_id, r.text, r.fp) for r in some)))
    assert len(kept) == 1
    assert [r[0] for r in next(iter(kept))] == [1, 2]
