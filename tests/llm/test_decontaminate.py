import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tractloom.llm import decontaminate as D

DOCS = "doc_id long, text string, contamination string, extra int"
ITEMS = "item_id long, text string, lang string"
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def brute(text, items, window=13):
    words = D.WORD_BYTES.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, t in items:
        w = D.WORD_BYTES.findall((t or "").encode().lower())
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def sample():
    rng = random.Random(3)
    items = [(k, " ".join(rng.choices(WORDS, k=n))) for k, n in enumerate((20, 13, 5, 1, 40, 14))] + [(90, None), (91, ""), (92, " ?! ")]
    texts = [None, "", " .,;", "alpha", "x" * 5000, items[0][1], "so " + items[1][1].upper().replace("É", "é") + ". " + items[4][1] + " end", " ".join(rng.choices(WORDS, k=900)), "tail " * 4000 + items[5][1]]
    docs = [(i, t, "clash", i) for i, t in enumerate(texts)] + [(None, items[0][1], "clash", 0), (5, items[0][1], "clash", 1)]
    return docs, items


@pytest.mark.parametrize("most", [D.MAX_BROADCAST_WINDOWS, 0])
def test_both_ways_agree_with_brute_force(spark, most):
    docs, items = sample()
    found = D.find_contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*i, "en") for i in items], ITEMS), max_broadcast_windows=most)
    rows = found.collect()
    assert len(rows) == len(docs) and set(found.columns) == {"doc_id", "text", "contamination", "extra"}
    for r in rows:
        o = r.contamination
        assert (o.n_words, o.n_hit, list(o.item_ids)) == brute(r.text, items), r.doc_id
        for s in o.spans:
            assert r.text[s.start : s.end].strip() == r.text[s.start : s.end]
        assert sum(len(D.WORD_TEXT.findall(r.text[s.start : s.end])) for s in o.spans) == o.n_hit


def test_removal(spark):
    docs, items = sample()
    found = D.find_contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*i, "en") for i in items if i[0] in (0, 1, 4)], ITEMS))
    clean = {r.doc_id: r.text for r in D.remove_spans(found).collect() if r.doc_id is not None}
    assert clean[6] == "so  end" and clean[1] == "" and clean[0] is None and clean[4] == "x" * 5000
    again = D.find_contamination(D.remove_spans(found), spark.createDataFrame([(*i, "en") for i in items if i[0] in (0, 1, 4)], ITEMS))
    assert again.where(F.col("contamination.n_hit") > 0).count() == 0
    assert {r.doc_id for r in D.drop_documents(found).collect()} == {0, 1, 2, 3, 4, 7, 8}


def test_empty_tables(spark):
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "alpha beta", "", 0)], DOCS)
    assert D.find_contamination(no_docs, no_items).count() == 0
    for most in (D.MAX_BROADCAST_WINDOWS, -1):
        o = D.find_contamination(some, no_items, max_broadcast_windows=most).first().contamination
        assert (o.n_words, o.n_hit, list(o.item_ids), list(o.spans)) == (2, 0, [], [])


@given(st.lists(st.sampled_from(WORDS[:3]), max_size=40), st.lists(st.lists(st.sampled_from(WORDS[:3]), max_size=8), max_size=4))
def test_scan_is_exact(words, items):
    rows = [(str(k), " ".join(w)) for k, w in enumerate(items)]
    o = D.WindowIndex.build(rows, 4).scan(" ".join(words))
    assert (o["n_words"], o["n_hit"], o["item_ids"]) == brute(" ".join(words), rows, 4)
