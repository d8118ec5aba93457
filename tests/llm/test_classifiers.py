import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tractloom.llm import language as L
from tractloom.llm import quality as Q
from tractloom.llm import toxicity as T
from tractloom.llm.common import fold_of

DOCS = "doc_id long, text string, lang string, score string, toxicity int, quality_score int, lang_pred int"
LABELS = "doc_id long, quality int, toxic int, text string"
SPEECH = {"aa": "the ther and onth ingre of hatio".split(), "bb": "der einsch und keit ungä zu enß".split(), "cc": "les éaux que tion oui ñe pas".split()}


def corpus(spark, n=900, odd=True):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        lang = "aa bb cc".split()[i % 3]
        words = ["".join(rng.choices(SPEECH[lang], k=rng.choice([1, 2, 2]))) for _ in range(rng.choice([12, 40, 90]))]
        quality, toxic = int(i % 5 != 1), int(i % 4 == 1)
        if not quality:
            words = [w + "%%%" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "zorgh" + rng.choice(["a", "el", "in", "oth"]) if i % 8 == 1 else rng.choice(["blasted", "wretch"]))
        docs.append((i, " ".join(words) + ".", lang, "s", 1, 1, 1))
        if i % 10 != 9:
            labels.append((i, quality, toxic, "clash"))
    if odd:
        docs += [(n, None, None, "s", 1, 1, 1), (n + 1, "", "aa", "s", 1, 1, 1), (None, "the and of", "aa", "s", 1, 1, 1), (n + 2, "word " * 60000, None, "s", 1, 1, 1), (n + 3, "123 456 !", "bb", "s", 1, 1, 1), (1, docs[1][1], "bb", "s", 1, 1, 1)]
        labels += [(None, 1, 1, ""), (3, None, None, ""), (1, 1, 1, ""), (n + 9, 1, 0, "")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def accuracy(rows):
    rows = list(rows)
    return sum(a == b for a, b in rows) / len(rows)


def test_quality_is_learnt_from_its_folds_alone(spark):
    docs, labels = corpus(spark)
    model = Q.fit_quality(docs, labels, features=48)
    scored = Q.score_quality(docs, model)
    assert scored.columns.count("quality_score") == 1 and scored.count() == docs.count()
    held = scored.where(fold_of(F.col("doc_id"), 4) == 2).join(labels.where("quality is not null").drop("text"), "doc_id").collect()
    assert accuracy((r.quality_score >= 0.7, r.quality == 1) for r in held) > 0.97
    assert all(0 <= r.quality_score <= 1 for r in scored.collect())
    blind = labels.withColumn("quality", F.when(fold_of(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = Q.fit_quality(docs, blind, features=48)
    assert np.allclose(model.weights, again.weights)


def plain_isotonic(x, y):
    """The increasing function nearest to y, by the largest of the least means (no pools)."""
    order = np.lexsort((y, x))
    y = y[order]
    n = len(y)
    sums = np.concatenate(([0.0], np.cumsum(y)))
    means = [[(sums[b] - sums[a]) / (b - a) if b > a else np.inf for b in range(n + 1)] for a in range(n)]
    return x[order], np.array([max(min(means[a][b] for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])


def test_quality_is_that_of_a_plain_fit(spark):
    """The whole fit in numpy on the driver: same rows, closed form, isotonic steps by definition; all scores agree."""
    docs, labels = corpus(spark, 200, odd=False)
    model = Q.fit_quality(docs, labels, features=24)
    fold = fold_of(F.col("doc_id"), 4)
    inner = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(4)) == 0
    rows = docs.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id").where(fold != 2).select("text", "quality", inner.alias("held")).collect()
    x, y, held = np.array([Q.statistics(r.text) for r in rows]), np.array([float(r.quality) for r in rows]), np.array([r.held for r in rows])
    mean, scale = x.mean(axis=0), np.sqrt(np.maximum((x**2).mean(axis=0) - x.mean(axis=0) ** 2, 1e-8))
    rng, d = np.random.default_rng(7), x.shape[1]
    waves, phases = rng.normal(size=(d, 24)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, 24)

    def features(v):
        v = np.clip((v - mean) / scale, -5, 5)
        return np.hstack([np.ones((len(v), 1)), v, np.sqrt(2 / 24) * np.cos(v @ waves + phases)])

    z = features(x[~held])
    weights = np.linalg.solve(z.T @ z + Q.RIDGE * len(x) * np.diag([1e-6] + [1e-2] * d + [1.0] * 24), z.T @ y[~held])
    assert np.allclose(model.weights, weights, rtol=1e-5, atol=1e-8)
    raw = features(x[held]) @ weights
    at, height = plain_isotonic(raw, y[held])
    ends = [i for i in range(len(at)) if i in (0, len(at) - 1) or height[i] != height[i - 1] or height[i] != height[i + 1]]
    size = np.array([(height == h).sum() for h in height])
    height = (height * size + y[held].mean()) / (size + 1)
    want = {r.text: np.interp((features(np.array([Q.statistics(r.text)])) @ weights)[0], at[ends], height[ends]) for r in docs.collect()}
    got = Q.score_quality(docs, model).collect()
    assert max(abs(r.quality_score - want[r.text]) for r in got) < 1e-5


def test_quality_without_labels(spark):
    docs, labels = corpus(spark, 30)
    for some, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {r[0] for r in Q.score_quality(docs, Q.fit_quality(docs, some)).select("quality_score").collect()} == {want}
    assert Q.score_quality(docs.limit(0), Q.fit_quality(docs.limit(0), labels)).count() == 0


@given(st.lists(st.tuples(st.floats(-5, 5), st.integers(0, 1)), min_size=2, max_size=60))
def test_isotonic_rises(rows):
    x, y = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    at, height = Q.isotonic(x, y)
    assert (np.diff(at) >= 0).all() and (np.diff(height) >= -1e-12).all() and height.min() >= 0 and height.max() <= 1


def test_statistics_of_odd_texts():
    assert Q.statistics(None) == Q.statistics("") == Q.statistics(" \n ") == [0.0] * len(Q.STATISTICS)
    assert len(Q.statistics("a")) == len(Q.STATISTICS) and all(np.isfinite(Q.statistics("x | y\n\n\ud800")))


def test_toxicity_learns_stems_and_generalises(spark):
    docs, labels = corpus(spark, 1200)
    grammar = T.fit_toxicity(docs, labels)
    assert {"blasted$", "wretch$", "zorgh"} <= set(grammar.stems) and len(grammar.stems) < 12
    scored = T.score_toxicity(docs, grammar, out="score")
    held = scored.where(fold_of(F.col("doc_id"), 3) == 1).join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    assert accuracy((r.score >= 0.7, r.toxic == 1) for r in held) > 0.99
    assert grammar.score("zorghunseen and zorghnever of") >= 0.7 and grammar.score(None) == grammar.score("") == grammar.score("the and") < 0.3
    some = T.matched_clauses(docs.where("doc_id = 1"), grammar).first().toxic_clauses
    assert len(some) >= 1 and some[0].words


def test_clause_context_changes_weights():
    g = T.Grammar({"scum$": 4.0, "lowei": 4.0}, np.array([-4.0, 2.0, 0.0, 0.0]), 0.01)
    weight = lambda s: sum(c["weight"] for c in g.clauses(s))
    assert weight("the scum is here.") == 4.0 and weight("you scum.") == weight("scum you.") == 4.0 + T.TARGETED and weight("scums") == 0
    assert weight("this is not scum") < weight("he said the scum left") < weight("the scum left")
    assert weight("he said: \"scum\" twice") == 4.0 + T.REPORTED and weight("scum, he said") == 4.0 + T.REPORTED
    assert weight("not one two three scum") == 4.0 and weight("not one two scum") == 4.0 + T.NEGATED
    assert weight("not here. scum!") == 4.0 and weight("Loweixyz lowei") == 8.0
    assert weight("they kill time") == weight("not kill he said") == 0 and weight("i kill you") == T.THREAT_WEIGHT + T.TARGETED
    assert g.score("you are scum") > g.score("not scum") > g.blank


def slow_paths(machines, symbols):
    """All accepted paths of a cascade: every path of the first machine, each of its outputs through the next, and so on."""
    found = [(0.0, list(symbols))]
    for m in machines:
        after = []
        for w, read in found:
            walks = [(w, [], s) for s in m.starts]
            for symbol in read:
                walks = [(v + more, [*out, o], to) for v, out, s in walks for o, more, to in m.arcs.get((s, symbol), ())]
            after += [(v, out) for v, out, s in walks if s in m.finals]
        found = after
    return found


@given(st.lists(st.sampled_from([*T.PLAIN, *T.HITS]), max_size=9))
def test_composition_has_the_paths_of_the_cascade(symbols):
    slow = slow_paths(T.machines(), symbols)
    fast = T.composed().paths(symbols)
    assert len(slow) == len(fast) == 1
    assert fast[0][1] == slow[0][1] and abs(fast[0][0] - slow[0][0]) < 1e-9


def test_lexicon_reads_the_longest_path():
    stems = {"zorg": 3.0, "zorgal$": 5.0, "kille": 4.0, "not$": 9.0}
    read = T.Lexicon(stems).read
    assert read("zorgh") == ("insult", 3.0) and read("zorgal") == ("insult", 5.0) and read("zorgals") == ("insult", 3.0) and read("zor") == ("word", 0.0)
    assert read("kill") == ("threat", 0.0) and read("killer") == ("insult", 4.0) and read("you") == ("target", 0.0) and read("yours") == ("target", 0.0) and read("not") == ("insult", 9.0)


def test_rare_stems_are_learnt_and_chance_is_not():
    """What the counts must be does not depend on a share of the sample; fixed against the exact binomial tail."""
    from math import comb

    for t, c, share in ((16, 0, 1 / 3), (30, 2, 1 / 3), (5, 0, 0.1), (40, 30, 0.5)):
        tail = sum(comb(t + c, k) * share**k * (1 - share) ** (t + c - k) for k in range(t, t + c + 1))
        assert np.exp(-T.surprise(t, c, share)) >= tail * (1 - 1e-9)
    assert T.surprise(16, 0, 1 / 3) > np.log(10**6) and T.surprise(20, 40, 1 / 3) == 0


def test_surprise_as_a_column_and_chosen_stems(spark):
    """The column says what the function says, and counts by a list of hashes are the counts of those stems."""
    rows = [(t, c) for t in (0, 1, 3, 8, 40) for c in (0, 1, 5, 90)]
    got = spark.createDataFrame(rows, "t long, c long").select("t", "c", T.surprise_column(F.col("t"), F.col("c"), 0.3).alias("s")).collect()
    assert all(abs(r.s - (T.surprise(r.t, r.c, 0.3) if r.t else 0.0)) < 1e-9 for r in got) and len(got) == len(rows)
    sample = spark.createDataFrame([(["zorgal", "größe"],), (["zorgh", "größer"],), ([],)], "words array<string>")
    every = {r.stem: r.n for r in T.stem_counts(sample).collect()}
    some = ["größe", "zorg", "zorgal$", "absent"]
    hashes = np.sort(spark.createDataFrame([(x,) for x in some], "x string").select(F.xxhash64("x").alias("h")).toArrow()["h"].to_numpy())
    assert {r.stem: r.n for r in T.stem_counts(sample, hashes).collect()} == {x: every[x] for x in some[:3]} == {"größe": 2, "zorg": 2, "zorgal$": 1}


def test_toxicity_of_empty_tables(spark):
    docs, labels = corpus(spark, 60)
    assert T.score_toxicity(docs.limit(0), T.fit_toxicity(docs.limit(0), labels)).count() == 0
    assert T.matched_clauses(docs.limit(0), T.Grammar()).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = corpus(spark, 30)
    for some in (labels.limit(0), labels.where("toxic = 1")):
        assert {r[0] for r in T.score_toxicity(docs, T.fit_toxicity(docs, some), out="score").select("score").collect()} == {0.0}


def test_languages(spark):
    docs, _ = corpus(spark)
    model = L.fit_languages(docs)
    assert model.languages == ["aa", "bb", "cc"]
    found = L.identify(docs, model)
    assert found.columns.count("lang_pred") == 1 and found.count() == docs.count()
    rows = found.where(fold_of(F.col("doc_id"), 4) == 2).where("lang is not null and text rlike '[a-z]'").collect()
    assert accuracy((r.lang, r.lang_pred) for r in rows) > 0.99
    odd = {r.doc_id: (r.lang_pred, r.lang_score) for r in found.where("doc_id >= 900").collect()}
    assert odd[900] == odd[901] == odd[903] == ("und", 0.0) and odd[902][0] in model.languages
    assert {r.lang_pred for r in L.identify(docs, L.fit_languages(docs.limit(0))).collect()} == {"und"}
    assert L.identify(docs.limit(0), model).count() == 0
    many = L.fit_languages(docs, max_part_bytes=30_000)
    assert len(many.parts) > 3 and many.order == model.order
    key = lambda r: (str(r.doc_id), str(r.text)[:20], r.lang_pred, round(r.lang_score, 9))
    assert sorted(map(key, L.identify(docs, many).collect())) == sorted(map(key, found.collect()))


def slow_bits(order, learnt, text):
    """The code length of a text in bits, by a walk over all contexts of all learnt texts."""
    grams = [g for t in learnt for d in [b" " * order + t.encode()] for g in (d[i : i + order + 1] for i in range(len(d) - order))]

    def p(context, byte):
        if context is None:
            return 1 / 256
        seen = [g[-1] for g in grams if g[order - len(context) : order] == context]
        shorter = context[1:] if context else None
        if not seen:
            return p(shorter, byte)
        hits, kinds = seen.count(byte), len(set(seen))
        return hits / (len(seen) + kinds) if hits else kinds / (len(seen) + kinds) * p(shorter, byte)

    d = b" " * order + text.encode()
    return sum(-np.log2(p(d[i : i + order], d[i + order])) for i in range(len(d) - order))


def test_whole_predictions_are_those_of_escape_c(spark):
    """Alphabets of many languages, against brute force: every language's code length, and so the prediction and score."""
    learnt = {"el": ["αβ βα γαβ", "γα β"], "ru": ["абв ваб баб", "ва"], "en": ["abracadabra abba", "a cab"], **{f"x{k}": [chr(97 + k) * 3 + " ab"] for k in range(9)}}
    rows = [(k, t, lang) for k, (lang, t) in enumerate((lang, t) for lang, ts in learnt.items() for t in ts)]
    tests = ["βαγ", "ваба", "abba cab", "\U0001f600a", "ddd", "mixed аб", "αаa"]
    for order in (1, 3, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = L.fit_languages(docs, folds=1, hidden=5, order=order)
        assert model.languages == sorted(learnt) and model.order == order
        found = {r.text: r for r in L.identify(spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "doc_id long, text string"), model).collect()}
        part = model.part(0)
        for t in tests:
            want = [slow_bits(order, learnt[lang], t) for lang in model.languages]
            (grams, _), = L.pieces([t], order)
            assert len(model.parts) == 1 and np.allclose(part.code(grams, order).sum(axis=0), want, rtol=1e-5)
            share = 1 / sum(2.0 ** max(min(want) - w, -1000) for w in want)
            assert found[t].lang_pred == model.languages[int(np.argmin(want))] and abs(found[t].lang_score - share) < 1e-4


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = "the ther äöü" * 50
    (whole, _), = L.pieces([text], 3)
    monkeypatch.setattr(L, "CHUNK", 17)
    cut = [g for g, o in L.pieces(["x", text, "", text], 3) for g, i in zip(g.tolist(), o.tolist(), strict=True) if i == 3]
    assert cut == whole.tolist()
