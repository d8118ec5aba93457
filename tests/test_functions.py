import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tractloom.functions import canonical, coordinates, households, text


def column(spark, rows, ddl, c):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(c).collect()]


def test_coordinate_states(spark):
    cases = [
        (None, "0", "missing"), (" ", "0", "missing"), ("x", "0", "invalid_parse"), ("1_000", "0", "invalid_parse"), ("1.5d", "0", "invalid_parse"), ("0x1p3", "0", "invalid_parse"),
        ("nan", "0", "invalid_nonfinite"), ("-Infinity", "0", "invalid_nonfinite"), ("1e999", "0", "invalid_nonfinite"), ("91", "0", "invalid_range"), ("0", "-180.1", "invalid_range"),
        ("90", "-180", "valid"), (" +.5 ", "1e1", "valid"), ("\t7.\n", "0", "valid"),
    ]
    got = column(spark, [c[:2] for c in cases], "a string, b string", coordinates.parsed_point(F.col("a"), F.col("b")))
    assert [g.state for g in got] == [c[2] for c in cases]
    assert got[9].latitude == 91.0 and got[5].latitude is None and got[12].latitude == 0.5


def test_albers_matches_published_numbers(spark):
    got = column(spark, [(-87.9, 43.0), (-96.0, 23.0), (None, 43.0)], "x double, y double", coordinates.albers(F.col("x"), F.col("y")))
    assert got[0].x == pytest.approx(656033.3612, abs=1e-3) and got[0].y == pytest.approx(2250677.3104, abs=1e-3)
    assert abs(got[1].x) < 1e-6 and abs(got[1].y) < 1e-6 and got[2] is None


def test_distances(spark):
    d = column(spark, [(3.0, 4.0)], "x double, y double", coordinates.planar_distance_m(F.col("x"), F.col("y"), F.lit(0.0), F.lit(0.0)))
    assert d == [5.0]
    h = column(spark, [(0.0, 0.0, 0.0, 180.0), (10.0, -20.0, 10.0, -20.0)], "a double, b double, c double, d double", coordinates.haversine_m(*map(F.col, "abcd")))
    assert h[0] == pytest.approx(math.pi * 6371008.8) and h[1] == 0.0


def test_household_tokens(spark):
    cases = [
        ("123", "9", "valid", 123), ("", "10", "missing", None), ("-999999999", "10", "suppressed", None), ("-888888888", "10", "inapplicable", None), ("not-a-number", "10", "invalid", None), ("5", "-555555555", "inapplicable", 5),
        ("-5", "1", "invalid", None), (None, None, "missing", None), ("99999999999999999999", "1", "invalid", None), ("-666666666", "-999999999", "suppressed", None), (" 5", "1", "invalid", None), ("-777777777", "", "invalid", None),
    ]
    got = column(spark, [c[:2] for c in cases], "a string, b string", households.parsed(F.col("a"), F.col("b")))
    assert [(g.status, g.estimate) for g in got] == [c[2:] for c in cases]
    assert got[0].status_detail.estimate == "estimate_PUBLISHED_INTEGER" and got[2].status_detail.estimate == "estimate_N_INSUFFICIENT_SAMPLE_CASES" and got[6].status_detail.estimate == "estimate_NEGATIVE_UNRECOGNIZED"


def test_text(spark):
    one = lambda v, f: column(spark, [(v,)], "a string", f(F.col("a")))[0]
    assert one(" 12 Main St. #4\n", text.normalised) == "12mainst4" and one(None, text.normalised) == ""
    assert one("FY20245 x", text.first_year) == 2024 and one("FY20245 x", text.only_year) is None and one("2024/2025", text.only_year) is None and one("in 2025.", text.only_year) == 2025 and one("none", text.first_year) is None
    assert [one(v, text.decimals) for v in ("10.0200", "10", "10.", "1.5e-7", None)] == [2, 0, 0, 4, 0]
    assert column(spark, [("Madison", "Milwaukee")], "a string, b string", text.market(F.col("a"), F.col("b"))) == ["milwaukee"]
    assert one("PIPE-01B", lambda c: text.is_governed(c, "task_id")) and not one("PIPE-01B\n", lambda c: text.is_governed(c, "task_id")) and not one("X-01", lambda c: text.is_governed(c, "task_id"))


def test_canonical(spark):
    v = {"b": [1, 2.0, 1e22, None, True], "a": "é\n"}
    assert canonical.written(v) == '{"a":"é\\n","b":[1,2.0,1e+22,null,true]}'
    with pytest.raises(ValueError):
        canonical.written(float("nan"))
    got = column(spark, [("é", 7)], "b string, a long", canonical.id_column("x", F.struct("b", "a")))[0]
    assert got == "x:sha256:" + hashlib.sha256('{"a":7,"b":"é"}'.encode()).hexdigest()
    nonce, digest = b"n" * 32, "ab" * 32
    c = spark.createDataFrame([(digest, bytearray(nonce))], "d string, n binary").select(canonical.commitment_column(F.col("d"), F.col("n"))).first()[0]
    assert c == canonical.commitment_of(digest, nonce)
    for bad in ((digest, b"short"), ("ab", nonce)):
        with pytest.raises(ValueError):
            canonical.commitment_of(*bad)
    document = F.struct(F.lit(1).alias("a"), F.lit("x").alias("h"))
    assert spark.range(1).select(canonical.self_hash_column(document, ["h"])).first()[0] == canonical.hexdigest({"a": 1})


def test_compiled_text_equals_the_written_one(spark):
    """Doubles of every size and length, all control characters, nested and null values; no Python in the plan."""
    rng = random.Random(3)
    numbers = [0.0, -0.0, 1.0, -2.5, 1e15, 1e16, 123456789012345680.0, 1e22, 1e-4, 1e-5, 2e-3, 9.007199254740993e15, 9.3e18, 2.82879384806159e17, 0.1, 0.30000000000000004, 2**53 + 2.0, 100.0, 1.1e-5, 4.35, 1 / 3]
    numbers += [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.randrange(-40, 22) for _ in range(3000)] + [rng.uniform(-1e4, 1e4) for _ in range(1500)] + [round(rng.uniform(-1e3, 1e3), rng.randrange(9)) for _ in range(1500)] + [2.0**k for k in range(-130, 73)]
    texts = ["", "plain", 'a "b" \\ /', "é日\U0001f600\x7f\u2028", "".join(map(chr, range(40)))]
    kind = "v struct<z:double,f:float,b:boolean,t:string,n:bigint,i:tinyint,l:array<struct<y:string,x:array<double>>>,e:void,`K k`:string>"
    rows = [((v, rng.choice([None, 1.5, 0.1]), rng.choice([True, False, None]), rng.choice([*texts, None]), rng.choice([None, -(2**63), 7]), 5, rng.choice([None, [], [("y", [v, None]), None, (None, None)]]), None, "k"),) for v in numbers] + [(None,)]
    df = spark.createDataFrame(rows, kind)
    both = df.select("v", canonical.canonical_column(F.col("v"), df).alias("jvm"))
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()
    bad = [(r.jvm, canonical.written(r.v.asDict(True) if r.v else None)) for r in both.collect()]
    assert [x for x in bad if x[0] != x[1]][:5] == []
    for odd in (math.nan, math.inf, 1e-41, 5e-324, 1e23):
        one = spark.createDataFrame([(odd,)], "v double")
        with pytest.raises(Exception, match="not finite, or beyond"):
            one.select(canonical.canonical_column(F.col("v"), one)).collect()
    with pytest.raises(TypeError):
        canonical.canonical_column(F.lit(b"x"), one)
