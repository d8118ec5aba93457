import time
from itertools import combinations, product

import numpy as np
from pyspark.sql import functions as F

from tractloom.llm import licenses, urls, wrapper

PAGE = """<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/{k}">Link {k}</a></li></ul></nav><div class="ad">Buy {k}</div><div id="cookie-notice">We use cookies</div>
<article><h1>Head {k} &amp; more</h1><p>First <b>text {k}</b> of&nbsp;it.<br><p>Second   part\n {k} &lt;tag&gt; &eacute; &#233; &am<p class="promo">Promo</p>
<p>Always the same line on this site</p><form><input name="q"><label>Find</label></form><div class="comments"><p>Reader {k}</p></div><p>Last {k}, unclosed</article>
<aside>Side {k}</aside><footer>&copy; {k}</footer></body></html>"""
WANT = "Head {k} & more\nFirst text {k} of it.\nSecond part {k} <tag> é é &am\nLast {k}, unclosed"
PAGES = "page_id long, url string, html string, text string, host string"


def test_wrapper_drops_template_and_what_is_no_article(spark):
    rows = [(k, f"http://site.example/{k}", PAGE.format(k=f"{k} " + "x y z " * (k % 3 + 3)), "clash", "h") for k in range(12)]
    odd = [(50, None, None, "c", "h"), (51, "http://site.example/e", "", "c", "h"), (52, "no host", "just words &amp; more", "c", "h"), (53, "http://b.example", "<p>one<p>two<div>three<ul><li>a<li>b</ul></div>", "c", "h"), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows + odd, PAGES)
    w = wrapper.induce_wrappers(pages)
    got = {r.page_id: r.text for r in wrapper.extract(pages, w).collect()}
    for k in range(12):
        assert got[k] == WANT.format(k=f"{k} " + "x y z " * (k % 3 + 3)).replace("  ", " "), k
    assert got[50] == got[51] == "" and got[52] == "just words & more" and got[53] == "one\ntwo\nthree\na\nb"
    big = wrapper.MAX_BROADCAST_SEED_CHARS
    wrapper.MAX_BROADCAST_SEED_CHARS = 0
    try:
        assert {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()} == got
    finally:
        wrapper.MAX_BROADCAST_SEED_CHARS = big
    assert wrapper.extract(pages.limit(0), wrapper.induce_wrappers(pages.limit(0))).count() == 0


def test_few_or_equal_pages_lose_nothing(spark):
    page = "<body><div>menu</div><main><p>All the same text</p><p>and more of it</p></main></body>"
    pages = spark.createDataFrame([(k, "http://c.example/", page, "", "") for k in range(9)], PAGES)
    assert {r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()} == {"All the same text\nand more of it"}


def test_template_without_an_article(spark):
    page = "<body><div class='top'>Our site</div><div><p>Story {k} is long and tells of many things {k}</p></div><div>Imprint and contact</div></body>"
    pages = spark.createDataFrame([(k, "http://d.example/", page.format(k=k), "", "") for k in range(9)], PAGES)
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()}
    assert all(got[k] == f"Story {k} is long and tells of many things {k}" for k in range(9))


def test_slots_that_recur_are_template_and_new_ones_content(spark):
    """No article element, no telling tags or classes: the wrapper alone decides."""
    page = "<body><div><p>Menu {m} of the site</p></div><div><h2>Head {k}</h2><p>Story {k} tells <b>of</b> many things</p><p>and it ends {k}</p></div><div><p>Closing words {f}</p></div></body>"
    rows = [(k, "http://e.example/", page.format(k=f"number {k}", m=k % 7, f=k % 11), "", "") for k in range(60)]
    copies = [(100 + k, "http://e.example/", page.format(k="copied", m=k % 7, f=k % 11), "", "") for k in range(40)]
    pages = spark.createDataFrame(rows + copies, PAGES)
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()}
    for k, name in [*((k, f"number {k}") for k in range(60)), *((100 + k, "copied") for k in range(40))]:
        assert got[k] == f"Head {name}\nStory {name} tells of many things\nand it ends {name}"


def test_two_kinds_of_pages_of_a_host(spark):
    """Each frame has a seed of its own, so a host's template is told on both of its kinds of pages."""
    rows = [(k, "http://f.example/", f"<body><div>Same top</div><article><p>Text {k} that is told once</p></article></body>", "", "") for k in range(8)]
    rows += [(50 + k, "http://f.example/", f"<body><table><tr><td>Same cell</td></tr></table><article><p>Fixed lead <i>in</i></p><p>Other {k} that is told once and is longer</p></article></body>", "", "") for k in range(8)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()}
    assert all(got[k] == f"Text {k} that is told once" and got[50 + k] == f"Other {k} that is told once and is longer" for k in range(8))


def test_class_words_on_body_and_article():
    text = "hello this is the article and all of the page"
    for page in (f"<body class='home has-sidebar'><article><p>{text}", f"<body class='no-sidebar'><p>{text}", f"<article class='post related'>{text}", f"<div class='widget'><p>{text}</div><p>x", f"<form id=f><div><p>{text}</form>"):
        assert text in wrapper.plain(wrapper.parse(page)), page
    assert wrapper.plain(wrapper.parse(f"<body><p>{text}<div class='share-price'>1.25</div><math>x</math></body>")) == f"{text}\n1.25\nx"
    assert wrapper.plain(wrapper.parse(f"<body><p>{text}</p><div class='related'>More</div><span class='ad'>Buy</span> tail 1 < 2</body>")) == f"{text}\ntail 1 < 2"


def test_boxes_of_undecided_slots_stay_out(spark):
    """Without any telling tag or class: menus and closing lines of new words on every page lie outside of the content's box."""
    page = "<body><div><ul><li>m{k}</li><li>n{k}</li></ul></div><div><h1>Head {k}</h1><p>Story {k} tells of many things in a longer line</p>{more}</div><div>Closing {f}</div></body>"
    rows = [(k, "http://g.example/", page.format(k=k, f=k % 13, more=f"<p>And more {k}</p>" * (k % 3)), "", "") for k in range(45)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce_wrappers(pages)).collect()}
    for k in range(45):
        assert f"Head {k}\nStory {k} tells" in got[k] and got[k].count("And more") == k % 3 and "Closing" not in got[k]


def test_forms_comments_articles_and_names():
    """Forms and reader comments of any size go, every article and its own header stays, and names count as a whole."""
    long = "many words of no article " * 40
    of = lambda page: wrapper.plain(wrapper.parse(page))
    assert of(f"<body><article><p>Short text.</p></article><div class='comments'><p>{long}</p></div></body>") == "Short text."
    assert of(f"<body><p>Short text.</p><section id='reader-comments'><article class='comment'><p>{long}</p></article></section></body>") == "Short text."
    assert of(f"<body><article><p>Short text.</p><form><p>{long}</p></form></article></body>") == "Short text."
    assert of("<body><article><p>One.</p></article><div>between</div><article><h2>Two</h2><p>Second article, longer.</p></article></body>") == "One.\nTwo\nSecond article, longer."
    assert of("<body><header>Site</header><main><article><header><h1>Title</h1></header><p>Text.</p><footer>By me</footer></article></main></body>") == "Title\nText."
    assert of("<body><article><div class='header-note'>A note.</div><div class='social-science'>Study.</div><div class='cookie-notice'>We use</div><div class='site-sidebar'>More</div></article></body>") == "A note.\nStudy."
    page, seed = wrapper.parse("<body><div class='related'><p>new text</p></div><div class='ad'><p>buy this and that</p></div></body>"), {}
    slots = {x.number: wrapper.CONTENT for x in wrapper.preorder(page) if not x.elements}
    assert wrapper.blocks(page, seed) == [] and wrapper.blocks(page, slots) == ["new text"]


def test_deep_and_broken_pages_in_linear_time():
    deep = wrapper.parse("<div>" * 3000 + "<p>bottom</p>" + "</div>" * 3000)
    other = wrapper.parse("<div>" * 2500 + "<p>bottom</p><ul><li>x</ul>" + "</div>" * 2500)
    assert wrapper.plain(deep) == "bottom" and len(wrapper.matched(deep, other, {})) > 2000
    begun = time.perf_counter()
    for broken in ("<a ", '<a title="', "<a title=\"x' ", "</b></i>", "<p><b>", "<li><ul>", "<!-- ", "<", "</", "<script>", "<table><tr><td>"):
        text = broken * (1_000_000 // len(broken))
        wrapper.plain(wrapper.parse(text))
    assert time.perf_counter() - begun < 120


def test_long_alignments_are_exact():
    rng = np.random.default_rng(5)
    for n, m in ((1, 9), (40, 60), (90, 70)):
        xs, ys, weights = rng.integers(0, 6, n), rng.integers(0, 5, m), rng.integers(0, 9, (6, 5))
        table = np.zeros((n + 1, m + 1), dtype=int)
        for i, j in product(range(n), range(m)):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + weights[xs[i], ys[j]])
        for cells in (1, 50, 10**9):
            wrapper.TABLE_CELLS, before = cells, wrapper.TABLE_CELLS
            found = wrapper.best_pairs(xs, ys, weights)
            wrapper.TABLE_CELLS = before
            assert sum(weights[xs[i], ys[j]] for i, j in found) == table[n, m]
            assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:], strict=False))
    long = "<body>" + "".join(f"<h{k % 6 + 1}>a</h{k % 6 + 1}>" for k in range(6000)) + "</body>"
    back = "<body>" + "".join(f"<h{k % 5 + 1}>a</h{k % 5 + 1}>" for k in range(6000)) + "</body>"
    assert len(wrapper.matched(wrapper.parse(long), wrapper.parse(back), {})) > 3000


def slow_match(a, b):
    """Simple tree matching as published: a full table over the children."""
    if a.key != b.key:
        return 0
    m = [[0] * (len(b.elements) + 1) for _ in range(len(a.elements) + 1)]
    for i, x in enumerate(a.elements):
        for j, y in enumerate(b.elements):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + slow_match(x, y))
    return 1 + m[-1][-1]


def test_matching_is_the_largest():
    trees = [wrapper.parse(h) for h in (PAGE, PAGE.replace("<aside>", "<p>x</p><aside>").replace("<h1>", "<p>a<p>b<h1>"), "<body><article><p>x<p>y</article></body>", "<div><ul><li>a<li>b</ul><p>z</div>", "<div><p>z<ul><li>a</ul></div>")]
    for a in trees:
        for b in trees:
            assert len(wrapper.matched(a, b, {})) == slow_match(a, b)


def test_licenses(spark):
    rows = [
        (1, "Intro text.\nThis work is licensed under the GNU General Public License, version 3.\nEnd"), (2, "Licensed under CC BY-NC 4.0."), (3, "LICENSED under the  Apache License, Version 2.0!"), (4, "Released under the MIT License. Released under the MIT License."),
        (5, "The software is provided \"as is\", without warranty of any kind. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction. Words. The software is provided as is, without warranty of any kind."),
        (7, None), (8, ""), (9, "licensed under cc by-nc 40"), (10, "x " * 50000 + ". Licensed under CC BY-NC 4.0. tail"), (None, "Licensed under CC BY-NC 4.0."), (1, "nothing"), (11, "licensed" + " " * 9000 + "under cc by 4.0."),
    ]
    found = licenses.scan(spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, rule string"))
    got = [(r.doc_id, r.license, list(r.sentence_ids)) for r in found.collect()]
    assert found.columns.count("rule") == 1
    assert got == [
        (1, "GPL-3.0-only", ["gpl-work"]), (2, "CC-BY-NC-4.0", ["cc-by-nc"]), (3, "Apache-2.0", ["apache-use"]), (4, "MIT", ["mit-use", "mit-use"]), (5, None, ["mit-warranty", "mit-grant"]), (6, "MIT", ["mit-grant", "mit-warranty"]),
        (7, None, []), (8, None, []), (9, None, []), (10, "CC-BY-NC-4.0", ["cc-by-nc"]), (None, "CC-BY-NC-4.0", ["cc-by-nc"]), (1, None, []), (11, "CC-BY-4.0", ["cc-by"]),
    ]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
ASF = """ * The ASF licenses this file to You under the Apache License, Version 2.0
 * (the "License"); you may not use this file except in compliance with
 * the License.  You may obtain a copy of the License at
 *
 *    http://www.apache.org/licenses/LICENSE-2.0"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details."""
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice."""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
CC = "This work is licensed under a Creative Commons\nAttribution{} 4.0 International License."


def test_genuine_wrapped_licenses(spark):
    want = [
        (MIT, "mit-text", "MIT"), (MIT.replace("\n", "\r\n"), "mit-text", "MIT"), (APACHE, "apache-notice", "Apache-2.0"), (ASF, "apache-notice", "Apache-2.0"), (APACHE[: APACHE.index("# You")], "apache-use-long", "Apache-2.0"),
        (GPL, "gpl-notice", "GPL-3.0-or-later"), (GPL[: GPL.index("\n\n")], "gpl-free", "GPL-3.0-or-later"), (GPL2, "gpl-any", "GPL"), (MPL, "mpl-use", "MPL-2.0"), (BSD2, "bsd-2", "BSD-2-Clause"), (BSD3, "bsd-3", "BSD-3-Clause"),
        (CC.format("-NonCommercial"), "cc-by-nc-long", "CC-BY-NC-4.0"), (CC.format(""), "cc-by", "CC-BY-4.0"), (CC.format("-ShareAlike"), "cc-by-sa", "CC-BY-SA-4.0"),
        ("A title\nReleased under the\nMIT License\nAnother line", "mit-use", "MIT"), ("This work is licensed under the GNU\nGeneral Public License, version 3.", "gpl-work", "GPL-3.0-only"),
        ("Licensed under\n\nCC BY 4.0.", None, None), ("not licensed under cc by 4.0", None, None), ("Released under the\x02MIT License", "mit-use", "MIT"), ("! \n" * 20000 + "all rights\nreserved", "all-rights", "proprietary"),
        ("Licensed under the Apache\nLicense, Version 2.0.", "apache-use", "Apache-2.0"), ("Licensed under\nCC BY-NC 4.0", "cc-by-nc", "CC-BY-NC-4.0"), ("This work is in the\npublic domain.", "public-domain", "public domain"),
    ]
    got = {r.k: (r.rule, r.license) for r in licenses.scan(spark.createDataFrame([(k, w[0]) for k, w in enumerate(want)], "k int, text string")).collect()}
    assert [(w[0], *got[k]) for k, w in enumerate(want)] == want
    assert {w[1] for w in want if w[1]} == {r[0] for r in licenses.RULES}


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def fixed(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1]) + len(r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_fixed_rules(spark):
    tries = [None, "", "nohost", "http://", "://org/", "HTTP://A.Example.ORG/en/1x?y#z", "http://example.org/es/2", "http://example.org/es", "http://xorg/", "http://org", "http://org/", "ftp://m.b.com/fr/x", "http://com/de/", "http://b.com/en", "http://a.b://org/fr/", "http://é.org/x y", "http://notexample.org/es/1", "x?u=http://q.com/de/1"]
    d = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(tries)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(d, RULES, []).collect()}
    for i, u in enumerate(tries):
        host, path, rule, verdict = fixed(u)
        assert got[i] == (host, path, rule, verdict or "allow"), u


def test_mined_rules(spark):
    rows = [(f"http://{'win-casino' if i % 3 == 0 else 'news'}{i % 2}.example.net/{'en' if i % 4 else 'ad'}/{i}.html", i % 3 == 0 and i % 4 != 0) for i in range(600)] + [(None, True), ("http://x.net/", None)]
    rules = urls.mine_rules(spark.createDataFrame(rows, "url string, block boolean"))
    assert rules and all(r["confidence"] >= urls.MIN_CONFIDENCE for r in rules)
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)] + [(900, "zz")], "page_id long, url string")
    judged = urls.judge(d, [], rules).collect()
    for r in judged:  # the index finds what a look at every rule finds
        have = set(spark.range(1).select(urls.tokens_of(F.lit(r.url))).first()[0]) if r.page_id in (0, 1, 3, 600, 900) else None
        if have is not None:
            assert (r.verdict == "block") == any(set(x["tokens"]) <= have for x in rules)
    assert sum((r.verdict == "block") == bool(rows[r.page_id][1]) for r in judged if r.page_id < 600) >= 550
    assert urls.mine_rules(spark.createDataFrame([], "url string, block boolean")) == []
    assert urls.judge(d.limit(0), [("block", "net", "/")], rules).count() == 0
    twice = urls.judge(d.unionByName(d), [], rules).groupBy("page_id", "verdict", "mined").count().collect()
    assert len(twice) == 603 and all(r["count"] == 2 for r in twice)


def test_hosts_paths_and_rules_are_those_of_sql(spark, tmp_path):
    """Host, path and the fixed rules as DuckDB states them."""
    import duckdb

    from tractloom.llm.queries import URL_RULES

    odd = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=/es/#f", "http://example.org", "ftp://x.Org#frag/a", "http://b.com/fr/", "http://com/de/x", "x.com/de/", None, "", "http://", "http://xcom/de/1", "http://q.com?/de/", "://com/de/y", "http://a://com/fr/z"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(odd)] + [(3, odd[3])], "page_id long, url string")
    pages.toPandas().to_parquet(f"{tmp_path}/p.parquet")
    cases = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}:{v}'" for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])))
    sql = f"""WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM '{tmp_path}/p.parquet'),
        cut AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
        SELECT page_id, host, path, CASE {cases} END AS ruled FROM cut ORDER BY ALL"""
    want = duckdb.sql(sql).fetchall()
    got = [(r.page_id, r.host, r.path, r.rule and f"{r.rule}:{r.verdict}") for r in urls.judge(pages, URL_RULES, []).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rules_are_all_that_brute_force_finds(spark):
    hosts = ["win-casino.example.net", "m.news.example.org", "a.shop.example.com", "b.shop.example.com"]
    rows = [(f"http{'s' if i % 3 else ''}://{hosts[i * i % 4]}/{'en' if i % 5 else 'de'}/promo{i}{'/' if i % 2 else '.html'}{'?ref=x&page=1' if i % 7 == 0 else ''}", i * 7 % 11 < 4 or i % 4 == 3) for i in range(90)]
    # Three urls are enough, the words promo12 and promo34 are one form, and a host's suffix is a token.
    rows += [(f"http://{h}.rare.example.net/x/{h}{k}", True) for k, h in enumerate(("u", "v", "w"))] + [(f"http://z{k}.example.net/offer{k}", True) for k in range(3)]
    shown = spark.createDataFrame(rows, "url string, block boolean")
    sets = [(frozenset(r.t), r.block) for r in shown.select(urls.tokens_of(F.col("url")).alias("t"), "block").collect()]
    where = {}
    for i, (have, _) in enumerate(sets):
        for token in have:
            where.setdefault(token, set()).add(i)
    first = {}  # tokens of the same urls are one, by the first of their names; tokens of all urls are none
    for token in sorted(where):
        if len(where[token]) < len(sets):
            first.setdefault(frozenset(where[token]), token)
    named = set(first.values())
    counts = {}
    for have, block in sets:
        own = sorted(have & named)
        for size in range(1, len(own) + 1):
            for c in combinations(own, size):
                n, b = counts.get(c, (0, 0))
                counts[c] = (n + 1, b + block)
    good = {c: b / n for c, (n, b) in counts.items() if b >= 3 and b / n >= urls.MIN_CONFIDENCE}
    want = {c: v for c, v in good.items() if not any(p in good and good[p] >= v for k in range(1, len(c)) for p in combinations(c, k))}
    rules = urls.mine_rules(shown)
    assert {tuple(r["tokens"]): r["confidence"] for r in rules} == want and len(rules) == len(want)
    assert all(r["support"] == counts[tuple(r["tokens"])][1] / len(rows) for r in rules)
    assert any("rare" in c[0] for c in want) and ("path=offer0",) in want and any(len(c) >= 3 for c in want)
