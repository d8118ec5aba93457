"""The contract queries: thin digests of what the operators give, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.llm import decontaminate, flac, language, licenses, merkle, mixing, quality, resample, sharding, simhash, toxicity, urls, wrapper
from tractloom.llm.common import fold_of, table

THRESHOLD = 0.7
WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    o = F.col("contamination")
    return found.select(
        "doc_id", o["n_words"].alias("n_words"), o["n_hit"].alias("n_hit"), F.size(o["item_ids"]).cast("long").alias("n_items"),
        ids_digest(o["item_ids"]).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"),
    )


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return judged(toxicity.score_toxicity(docs, grammar, out="score"), 3, 1)


def judged(scored: DataFrame, folds: int, hidden: int) -> DataFrame:
    return scored.select("doc_id", (fold_of(F.col("doc_id"), folds) == hidden).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mix(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.fit_languages(docs), score_out="score")
    return found.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = flac.read_media(flac.add_media(docs))
    return read.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "read.*")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return judged(quality.score_quality(docs, model, out="score"), 4, 2)


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = wrapper.extract(pages.select("page_id", "url", "html"), wrapper.induce_wrappers(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), "rule", "license", F.size("sentence_ids").cast("long").alias("n_sentences"))


# The rules of the contract.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by its document, whose number ends its path: block is low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(urls.path_of(F.col("url")), "/([0-9]{1,18})(?:\\.[a-z]+)?/?$", 1)
    bad = labels.groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("block"))
    labelled = pages.where(number != "").withColumn("doc_id", number.cast("long")).join(bad, "doc_id").select("url", "block")
    found = urls.judge(pages, URL_RULES, urls.mine_rules(labelled))
    return found.select("page_id", "host", "path", "rule", "verdict", F.array_join(F.col("mined.tokens"), " ").alias("mined_rule"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def manifested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document, by its id's crc32, is held against the manifest with the line ends of its text taken out."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    spoilt = F.when(fold_of(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    seen = merkle.leaf_digest([spoilt if f == "text" else F.col(f) for f in merkle.FIELDS])
    found = merkle.manifest(docs.withColumn("seen_leaf", seen), keep=("seen_leaf",))
    found = found.withColumn("folded_root", merkle.fold(F.col("seen_leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_decontamination": decontaminated,
    "op2_toxicity": toxic,
    "op3_mixing": mixed,
    "op4_language_id": languages,
    "op5_main_text": main_text,
    "op6_flac_media": media,
    "op7_license_scan": license_scan,
    "op8_url_filter": url_verdicts,
    "op9_simhash_near_dedup": near_duplicates,
    "op10_quality": good,
    "op11_hilbert_shards": shards,
    "op12_importance_resampling": resampled,
    "op13_merkle_manifest": manifested,
}

# crc32 in SQL: a table of 256 by its polynomial, then a fold over the bytes, which are read from the hex form of the UTF-8 text.
CRC_TABLE_SQL = "crc AS (SELECT list(v ORDER BY b) AS tab FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) r(b)))"


def crc32_sql(said: str) -> str:
    octets = f"list_transform(range(strlen({said})), lambda i: ('0x' || substr(hex(encode({said})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"


LEAF_SQL = "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

#: The rest is learnt, drawn, hashed or decoded; tests hold those against brute force, round trips or held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
        WITH low AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
        items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
        windows AS (
            SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS part
            FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
        ),
        lengths AS (SELECT DISTINCT n FROM windows),
        spread AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM low, lengths WHERE len(w) >= n),
        hits AS (SELECT s.doc_id, s.i, s.n, x.item_id FROM spread s JOIN windows x ON x.n = s.n AND x.part = array_to_string(list_slice(s.w, s.i, s.i + s.n - 1), ' ')),
        words_hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
        FROM low d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN found f USING (doc_id)
    """,
    "op7_license_scan": licenses.scan_sql(),
    "op12_importance_resampling": f"""
        WITH {CRC_TABLE_SQL},
        docs AS (SELECT doc_id, {WORDS_SQL} AS w, row_number() OVER () AS pos FROM documents),
        aim AS (SELECT {WORDS_SQL} AS w FROM benchmark),
        parts AS (SELECT pos, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM docs),
        goal AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM aim),
        named AS (SELECT f, {crc32_sql("f")} % 10000 AS bucket FROM (SELECT f FROM parts UNION SELECT f FROM goal), crc),
        s AS (SELECT bucket, count(*) AS n FROM parts JOIN named USING (f) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM goal JOIN named USING (f) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(n), 0) + 10000 FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE AS t),
        gain AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * sums.s) / ((s.n + 1)::DOUBLE * sums.t)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), sums),
        weighed AS (SELECT pos, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM parts JOIN named USING (f) JOIN gain USING (bucket) GROUP BY pos),
        scored AS (SELECT pos, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS long_enough,
                          (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM docs LEFT JOIN weighed USING (pos)),
        drawn AS (SELECT pos, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM scored WHERE long_enough)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (pos)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {CRC_TABLE_SQL},
        seen AS (SELECT *, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS later FROM documents, crc),
        leaves AS (SELECT doc_id, source, {LEAF_SQL.format("text")} AS leaf, {LEAF_SQL.format("later")} AS seen_leaf FROM seen),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM leaves),
        nodes AS (
            SELECT g, 0 AS k, r AS pos, leaf AS d, count(*) OVER (PARTITION BY g) AS n FROM ranked
            UNION ALL
            SELECT g, k, pos, d, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, k + 1 AS k, pos // 3 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM nodes WHERE n > 1 GROUP BY g, k, pos // 3)
        ),
        tops AS (
            SELECT 0 AS k, g AS pos, d, count(*) OVER () AS n FROM nodes WHERE n = 1
            UNION ALL
            SELECT k, pos, d, count(*) OVER () AS n FROM (SELECT k + 1 AS k, pos // 3 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM tops WHERE n > 1 GROUP BY k, pos // 3)
        ),
        runs AS (SELECT 0 AS part, g, k, pos // 3 AS run, list(d ORDER BY pos) AS ds FROM nodes WHERE n > 1 GROUP BY ALL UNION ALL SELECT 1, 0, k, pos // 3, list(d ORDER BY pos) FROM tops WHERE n > 1 GROUP BY ALL),
        steps AS (SELECT r.g, r.r, u.part, u.k, u.ds, (r.r // pow(3, u.k)::BIGINT) % 3 + 1 AS own FROM ranked r JOIN runs u ON u.part = 0 AND u.g = r.g AND u.run = r.r // pow(3, u.k + 1)::BIGINT
                  UNION ALL SELECT r.g, r.r, u.part, u.k, u.ds, (r.g // pow(3, u.k)::BIGINT) % 3 + 1 FROM ranked r JOIN runs u ON u.part = 1 AND u.run = r.g // pow(3, u.k + 1)::BIGINT),
        proofs AS (SELECT g, r, list({{'l': array_to_string(ds[1:own - 1], ''), 'r': array_to_string(ds[own + 1:], '')}} ORDER BY part, k) AS p FROM steps GROUP BY g, r),
        whole AS (SELECT *, CASE WHEN p IS NULL THEN seen_leaf ELSE list_reduce(list_prepend({{'l': seen_leaf, 'r': ''}}, p), lambda own, x: {{'l': sha256(x.l || own.l || x.r), 'r': ''}}).l END AS folded FROM ranked LEFT JOIN proofs USING (g, r))
        SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(coalesce(array_to_string(list_transform(p, lambda x: x.l || x.r), ''), '')) AS proof_sha256, folded AS folded_root, folded = t.d AS verified
        FROM whole JOIN (SELECT g, d FROM nodes WHERE n = 1) s USING (g), (SELECT d FROM tops WHERE n = 1) t
    """,
}
