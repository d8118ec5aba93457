"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised (lower case, punctuation to spaces, one space between words, dotted
version numbers kept), and known sentences become identifiers; all others fall away. The identifiers of a document, in
order, are matched against ordered rules: a rule is a sequence of identifiers that must appear in that order, with
other known sentences between allowed. The first rule that matches names the licence.

A known sentence must start and end at a cut, and may have cuts inside: licence texts are wrapped at any word, put ';'
into a sentence and write 'v. 2.0'. It never spans an empty line. All known sentences are one pattern, the longest
first, read once over the normalised text. The tables of sentences, their other forms and rules are parameters, small by
nature and part of the plan. The SQL cuts at every mark and line and knows no other forms: it says the same wherever
known sentences stand in one line.

Defined cases: null and empty texts have no sentences, no rule and a null licence; a repeated sentence repeats its
identifier; repeated rows are scanned alike; an empty table gives an empty result; an input column named like an output
is replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences by which licences are declared, as normalised, and their identifiers.
SENTENCES = {
    "gpl-work": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "apache-use": "licensed under the apache license version 2.0",
    "apache-use-long": "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "mit-use": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-warranty": "the software is provided as is without warranty of any kind",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-nc-long": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-use": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "public-domain": "this work is in the public domain",
    "all-rights": "all rights reserved",
}
# Other genuine forms of known sentences, as normalised, and the identifier of each.
FORMS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "the asf licenses this file to you under the apache license version 2.0 the license you may not use this file except in compliance with the license": "apache-use-long",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "cc-by-sa",
    "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
}
# Rules in the order they are tried (name, licence, identifiers in order).
RULES = [
    ("gpl-notice", "GPL-3.0-or-later", ("gpl-free", "gpl-warranty")),
    ("gpl-free", "GPL-3.0-or-later", ("gpl-free",)),
    ("gpl-work", "GPL-3.0-only", ("gpl-work",)),
    ("gpl-any", "GPL", ("gpl-redistribute",)),
    ("apache-notice", "Apache-2.0", ("apache-use-long", "apache-copy")),
    ("apache-use-long", "Apache-2.0", ("apache-use-long",)),
    ("apache-use", "Apache-2.0", ("apache-use",)),
    ("mit-text", "MIT", ("mit-grant", "mit-warranty")),
    ("mit-use", "MIT", ("mit-use",)),
    ("bsd-3", "BSD-3-Clause", ("bsd-redistribution", "bsd-endorse")),
    ("bsd-2", "BSD-2-Clause", ("bsd-redistribution",)),
    ("mpl-use", "MPL-2.0", ("mpl-use",)),
    ("cc-by-nc-long", "CC-BY-NC-4.0", ("cc-by-nc-long",)),
    ("cc-by-nc", "CC-BY-NC-4.0", ("cc-by-nc",)),
    ("cc-by-sa", "CC-BY-SA-4.0", ("cc-by-sa",)),
    ("cc-by", "CC-BY-4.0", ("cc-by",)),
    ("public-domain", "public domain", ("public-domain",)),
    ("all-rights", "proprietary", ("all-rights",)),
]
# Where a sentence ends; what follows the mark belongs to the next one.
CUT = "[.!?;]+([\\t\\n\\f\\r \"')\\]}]|\\z)"
SOFT, HARD = "\x02", "\x03"
OTHER = "[^a-z0-9\\x01\\x{80}-\\x{10FFFF}]+"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def marked(text: Column) -> Column:
    """The words of a text in lower case with one space, SOFT (a cut) or HARD (an empty line) between, HARD at both ends.

    A dot stays between digits only.
    """
    own = F.translate(F.coalesce(text, F.lit("")), SOFT + HARD, "--")
    dotted = ascii_lower(F.regexp_replace(own, CUT, f"{SOFT}$1"))
    for _ in range(2):  # twice, as in 1.2.3 the matches overlap
        dotted = F.regexp_replace(dotted, "([0-9])\\.([0-9])", "$1\x01$2")
    out = F.concat(F.lit("\n\n"), F.regexp_replace(dotted, OTHER.replace("\\x01", f"\\x01\n{SOFT}"), " "), F.lit("\n\n"))
    # Each pattern takes a run of marks at once, so long runs cost no more than their length.
    out = F.regexp_replace(out, f"[ {SOFT}]*{SOFT}[ {SOFT}]*", SOFT)
    out = F.regexp_replace(out, f"[ {SOFT}]?\n[ {SOFT}]?\n[ {SOFT}\n]*", HARD)
    return F.translate(F.regexp_replace(out, f"[ {SOFT}]?\n[ {SOFT}]?", SOFT), "\x01", ".")


def sentence_ids(text: Column, sentences: dict[str, str], forms: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    by_text = {s: name for name, s in sentences.items()} | (forms or {})
    longest_first = sorted(by_text, key=lambda s: (-len(s), s))
    one_of = "|".join(f"[ {SOFT}]".join(map(re.escape, s.split(" "))) for s in longest_first)
    known = F.create_map(*[F.lit(x) for pair in by_text.items() for x in pair])
    found = F.regexp_extract_all(marked(text), F.lit(f"(?<=[{SOFT}{HARD}])({one_of})(?=[{SOFT}{HARD}])"), 1)
    return F.transform(found, lambda s: F.element_at(known, F.translate(s, SOFT, " ")))


def in_order(ids: Column, wanted: tuple[str, ...]) -> Column:
    """Whether the identifiers hold the wanted ones in order."""
    rest = ids
    for w in wanted[:-1]:
        at = F.array_position(rest, w)
        rest = F.when(at > 0, F.slice(rest, at.cast("int") + 1, F.size(rest)))
    return F.coalesce(F.array_contains(rest, wanted[-1]), F.lit(False))


def scan(
    docs: DataFrame, *, text: str = "text", sentences: dict[str, str] | None = None, rules: list[tuple[str, str, tuple[str, ...]]] | None = None, forms: dict[str, str] | None = None,
) -> DataFrame:
    """docs with sentence_ids, rule and license, in one pass and without a shuffle; own sentences have own forms."""
    forms = forms or ({} if sentences else FORMS)
    sentences, rules = sentences or SENTENCES, rules or RULES
    found = docs.withColumn("sentence_ids", sentence_ids(F.col(text), sentences, forms))
    rule = license_ = None
    for name, licence, wanted in rules:
        hit = in_order(F.col("sentence_ids"), wanted)
        rule = F.when(hit, name) if rule is None else rule.when(hit, name)
        license_ = F.when(hit, licence) if license_ is None else license_.when(hit, licence)
    return found.withColumn("rule", rule).withColumn("license", license_)


def scan_sql(documents: str = "documents", sentences: dict[str, str] | None = None, rules: list[tuple[str, str, tuple[str, ...]]] | None = None) -> str:
    """The same scan as SQL over (doc_id, text)."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    cases = " ".join(f"WHEN '{s}' THEN '{name}'" for name, s in sentences.items())
    dotted = "translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for _ in range(2):
        dotted = f"regexp_replace({dotted}, '([0-9])\\.([0-9])', '\\1' || chr(1) || '\\2', 'g')"
    normal = f"translate(trim(regexp_replace({dotted}, '{OTHER}', ' ', 'g')), chr(1), '.')"
    cut = f"string_split(regexp_replace(coalesce(text, ''), '{CUT.replace("'", "''")}', chr(10) || '\\1', 'g'), chr(10))"
    tests = [(name, licence, ",(.*,)?".join(wanted)) for name, licence, wanted in rules]
    pick = lambda k: " ".join(f"WHEN regexp_matches(',' || ids || ',', ',{t[2]},') THEN '{t[k]}'" for t in tests)
    return f"""
        WITH cut AS (SELECT doc_id, unnest({cut}) AS s, generate_subscripts({cut}, 1) AS pos FROM {documents}),
        known AS (SELECT doc_id, pos, CASE x {cases} END AS id FROM (SELECT doc_id, pos, {normal} AS x FROM cut)),
        listed AS (SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids, count(id) AS n FROM known WHERE id IS NOT NULL GROUP BY doc_id),
        filled AS (SELECT d.doc_id, coalesce(ids, '') AS ids, coalesce(n, 0) AS n FROM {documents} d LEFT JOIN listed USING (doc_id))
        SELECT doc_id, ids AS sentence_ids, CASE {pick(0)} END AS rule, CASE {pick(1)} END AS license, n::BIGINT AS n_sentences FROM filled
    """
