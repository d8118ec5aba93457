import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tractloom.llm import resample as R

DOCS = "doc_id long, text string, score int, rank string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def by_hand(docs, target, buckets=10_000, least=20, percent=25):
    of = lambda text: [zlib.crc32(f.encode()) % buckets for f in features(text)]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(of(text))
    for text in target:
        t.update(of(text))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, text in docs:
        f = of(text)
        gain = [math.floor(1000 * math.log((float(t[b] + 1) * all_s) / (float(s[b] + 1) * all_t))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if (r[1] + 1) // 2 >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=repr)


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "délta", "日本", "x1", "9", "İstanbul", "ß", "naïve", "the", "of"]
    marks = [" ", "  ", ", ", "\n", "-", "\t", " ", "…", "/"]
    return [(i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.choice([0, 3, 19, 20, 60, 200])))) for i in range(n)]


def run(spark, docs, target, **kw):
    d = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], DOCS)
    b = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    return sorted(map(tuple, R.resample(d, b, **kw).collect()), key=repr)


def test_equals_brute_force(spark):
    docs = corpus()
    assert run(spark, docs, ["alpha beta the of délta", None, "", "9 x1 日本 gamma"]) == by_hand(docs, ["alpha beta the of délta", None, "", "9 x1 日本 gamma"])


def test_split_gives_words_with_offsets():
    text = "Ünder_score 9a\x00b\x7fc -- \U0001f600ok\n" + "x" * 5000
    low = text.encode().lower().decode()
    cut = R.splitter().pre_tokenize_str(low)
    assert [w for w, _ in cut] == WORD.findall(low) == [low[a:b] for _, (a, b) in cut]
    assert R.splitter().pre_tokenize_str("") == [] == R.splitter().pre_tokenize_str("- \n_")


def test_a_task_forgets_words_and_gives_the_same(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(300))
    whole = R.Cutter(977)(text)
    monkeypatch.setattr(R, "KNOWN_WORDS", 3)
    assert R.Cutter(977)(text) == whole


def test_draw_leans_to_the_target(spark):
    rng = random.Random(2)
    near, far = [f"n{i}" for i in range(40)], [f"f{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(near if i % 4 == 0 else far, k=60))) for i in range(800)]
    drawn = [r for r in run(spark, docs, [" ".join(rng.choices(near, k=400))]) if r[4] is not None]
    assert len(drawn) == 200 and sum(r[0] % 4 == 0 for r in drawn) > 100  # 50 by chance


def test_odd_rows(spark):
    twenty = " ".join(f"w{i}" for i in range(20))
    docs = [(1, None), (2, ""), (None, twenty), (None, twenty), (3, twenty), (3, twenty), (4, " ".join(f"w{i}" for i in range(19))), (5, "long " * 30_000), (6, twenty), (7, twenty)]
    for target in ([], ["w1 w2"]):
        assert run(spark, docs, target) == by_hand(docs, target)
    assert run(spark, [], ["a b"]) == []
    d = spark.createDataFrame([(1, "a b", 5, "kept")], DOCS)
    assert R.resample(d.withColumnRenamed("rank", "was"), d, keep=("was",)).collect() == [(1, 3, 0, 0 + R.resample(d, d).first().score, None, "kept")]
    with pytest.raises(ValueError):
        R.resample(d, d, keep=("rank",))
    with pytest.raises(ValueError):
        R.feature_buckets(F.col("text"), 70_000)
