import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractloom.llm import sharding as S
from tractloom.llm.ordering import placed

DOCS = "doc_id long, text string, source string, lang string, n_chars long, size int, shard string, curve int"


def docs_of(spark, n=700, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        text = rng.choice(["same text again", "é" * rng.randint(0, 30), "w " * rng.randint(1, 400)])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "ünïc", None])
        rows.append((i, text, source, rng.choice(["en", "de", None]), rng.choice([len(text), None, 0, 10**6]), 1, "x", 2))
    return spark.createDataFrame(rows, DOCS)


def test_curve_visits_all_cells_by_steps_of_one():
    for bits, dims in ((1, 2), (4, 2), (3, 3), (2, 4), (6, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = S.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all() and not walk[0].any()


def test_places_are_those_of_a_sort(spark):
    rows = [(random.Random(i).choice([None, 1, 1, 2, 5]), i % 7, i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, w long").repartition(5)
    got = placed(df, ["a", "b"], "w").collect()
    got.sort(key=lambda r: r.rank)
    assert [r.rank for r in got] == list(range(500))
    keys = [((r.a is not None, r.a or 0), r.b) for r in got]
    assert keys == sorted(keys)
    assert [r.before for r in got] == [sum(x.w for x in got[:i]) for i in range(500)]


def bins_by_hand(values, bits):
    """Equal shares of the rows in the order of their values, nulls first; a value's middle row decides."""
    counts = Counter(values)
    seen, out = 0, {}
    for v in sorted(counts, key=lambda v: (v is not None, v if v is not None else 0)):
        out[v] = min(int((seen + counts[v] / 2) * (1 << bits) / len(values)), (1 << bits) - 1)
        seen += counts[v]
    return out


def test_rows_law_against_brute_force(spark):
    docs = docs_of(spark)
    got = S.shard(docs, shards=24, bits=5).join(docs.select("doc_id", "text", "source", "lang", "n_chars", F.xxhash64("text").alias("h")), "doc_id").collect()
    coarse = lambda v: None if v is None else int(np.floor(np.log2(1.0 + v) * S.STEPS))
    dims = [[r.source.encode() if r.source is not None else None for r in got], [r.lang.encode() if r.lang else None for r in got], [coarse(r.n_chars) for r in got]]
    binned = np.array([[bins_by_hand(d, 5)[v] for v in d] for d in dims]).T
    place = S.hilbert(binned, 5)
    assert [r.curve for r in got] == place.tolist()
    order = sorted(range(len(got)), key=lambda i: (place[i], got[i].h, got[i].doc_id))
    for rank, i in enumerate(order):
        r, shard = got[i], rank * 24 // 700
        assert (r["shard"], r.slot) == (shard, rank - -(-shard * 700 // 24))
        octets = r.text.encode()
        assert (r["size"], r.text_crc32, r.law) == (len(octets) + 8, zlib.crc32(octets), "rows")


@pytest.mark.parametrize("law", S.LAWS)
def test_laws(spark, law):
    docs = docs_of(spark, 900)
    got = S.shard(docs, law=law, shards=7, keep=("source", "lang")).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert len(got) == 900 and set(by) == set(range(7))
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    if law == "rows":
        assert {len(rows) for rows in by.values()} <= {900 // 7, 900 // 7 + 1}
    else:
        sizes, most = [sum(r["size"] for r in rows) for rows in by.values()], max(r["size"] for r in got)
        assert max(abs(s - sum(sizes) / 7) for s in sizes) <= most
    again = S.shard(docs.repartition(3), law=law, shards=7, keep=("source", "lang")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_filters_on_any_dimension_skip_shards(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "t", f"s{rng.randint(0, 15):02}", "en", rng.randint(1, 5000), 0, "", 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    made = S.shard(docs, dims=("source", "n_chars"), shards=64, bits=6, keep=("source", "n_chars"))
    zones = S.zone_map(made, ("source", "n_chars")).cache()
    assert zones.count() == 64
    for wanted, most in (({"source": ("s03", "s03")}, 16), ({"n_chars": (100, 400)}, 20), ({"source": ("s03", "s04"), "n_chars": (2000, 2500)}, 12)):
        kept = {r["shard"] for r in S.shards_for(zones, wanted).collect()}
        hold = {r["shard"] for r in made.where(" and ".join(f"{c} between {a!r} and {b!r}" for c, (a, b) in wanted.items())).select("shard").distinct().collect()}
        assert hold <= kept and len(kept) <= most
    S.write_shards(made, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000 and back.where("shard = 5").count() == made.where("shard = 5").count()


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, 0, "", 0)] * 30 + [(1, "", "a", "en", -5, 0, "", 0), (2, "x" * 300_000, "a", "", 10**12, 0, "", 0), (1, "", "a", "en", -5, 0, "", 0)]
    got = S.shard(spark.createDataFrame(rows, DOCS), shards=24).collect()
    assert len(got) == 33 and {r["size"] for r in got} == {8, 300_008} and Counter(r["shard"] for r in got).most_common()[0][1] == 2
    assert all(r.text_crc32 == 0 for r in got if r["size"] == 8)
    empty = S.shard(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "size", "text_crc32"]
    assert sorted(r["shard"] for r in S.shard(spark.createDataFrame(rows[-3:], DOCS), shards=24).collect()) == [0, 8, 16]
    numbers = spark.createDataFrame([(1, "a", float("nan")), (2, "b", -3.5), (3, "c", None)], "doc_id long, text string, v double")
    assert S.shard(numbers, dims=("v",), shards=3).orderBy("shard").select("doc_id").collect() == [(3,), (2,), (1,)]
    with pytest.raises(ValueError):
        S.shard(numbers, dims=("v",), keep=("size",))
    with pytest.raises(ValueError):
        S.shard(numbers, dims=("v",), law="luck")
