import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tractloom.llm import merkle as M

DOCS = "doc_id long, source string, lang string, n_chars long, text string, root string, n int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(leaves, fan):
    """The root over (name, digest) and each name's siblings, level by level."""
    runs = [([name], d) for name, d in leaves]
    proof = {name: [] for name, _ in leaves}
    while len(runs) > 1:
        up = []
        for i in range(0, len(runs), fan):
            part = runs[i : i + fan]
            for k, (names, _) in enumerate(part):
                for name in names:
                    proof[name].append(("".join(d for _, d in part[:k]), "".join(d for _, d in part[k + 1 :])))
            up.append((sum((names for names, _ in part), []), H(*[d for _, d in part])))
        runs = up
    return runs[0][1], proof


def by_hand(rows, fan=3):
    by = {}
    for k, row in enumerate(rows):
        by.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), k))
    trees, names = {}, sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s] = tree([(k, d) for _, _, d, k in sorted(by[s])], fan)
    root, above = tree([(s, trees[s][0]) for s in names], fan)
    return sorted(((row[0], row[1], leaf_of(row), trees[row[1]][0], root, tuple(trees[row[1]][1][k] + above[row[1]])) for k, row in enumerate(rows)), key=repr)


def got(spark, rows, fan=3):
    made = M.manifest(spark.createDataFrame([(*r, "x", 9) for r in rows], DOCS), fan=fan, keep=("n",)).collect()
    assert all(r.n == 9 for r in made)
    return sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in made), key=repr)


@pytest.mark.parametrize("fan", [2, 3, 5])
def test_equals_brute_force(spark, fan):
    rng = random.Random(fan)
    spec = [("a", 1), ("b", 2), ("é", 3), ("z", 4), ("", 10), ("hot", 130), ("Z", 27)]
    rows = [(i, s, rng.choice(["en", None]), i % 5, f"text {i}\n") for i, s in enumerate(s for s, n in spec for _ in range(n))]
    rng.shuffle(rows)
    assert got(spark, rows, fan) == by_hand(rows, fan)


def test_fold_and_tampering(spark):
    rows = [(i, "s" if i % 3 else "t", "en", 1, f"a\n{i}" if i % 2 else "plain", "", 0) for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS)
    later = M.leaf_digest([F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in M.FIELDS])
    m = M.manifest(docs.withColumn("later", later), keep=("later",)).withColumn("now", M.fold(F.col("leaf"), F.col("proof"))).withColumn("then", M.fold(F.col("later"), F.col("proof"))).collect()
    assert all(r.now == r.root for r in m) and len({r.root for r in m}) == 1
    assert all((r.then == r.root) == (r.doc_id % 2 == 0) for r in m)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (5, None, "", 0, ""), (5, None, "x", 0, ""), (1, "", "-", None, "é\x00\n"), (2, "one", "en", -3, "w " * 60_000)]
    assert got(spark, rows) == by_hand(rows)
    copies = [(7, "s", "en", 1, "same")] * 11
    assert got(spark, copies) == by_hand(copies)
    assert M.manifest(spark.createDataFrame([], DOCS)).count() == 0
    alone = M.manifest(spark.createDataFrame([(*rows[4], "x", 9)], DOCS)).first()
    assert alone.leaf == alone.subroot == alone.root and alone.proof == [] and alone.leaf_rank == 0
    with pytest.raises(ValueError):
        M.manifest(spark.createDataFrame([], DOCS), keep=("root",))
