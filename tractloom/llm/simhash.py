"""SimHash near-duplicate detection with a covering locality-sensitive hash.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 values (seed 42) of a document's word
shingles, repeats included. Fingerprints at `radius` or fewer differing bits are linked. Every bit position i gets a
code c(i) from 1 to 2^(radius+1)-1, and table v, for v in the same range, keeps the positions where c(i) and v have an
odd number of ones in common. Any `radius` differing positions give `radius` equations over radius+1 bits, so some v
other than 0 meets them all: in that table none of them is kept and the two fingerprints collide. No pair is missed.

All of it works on distinct fingerprints, so exact copies cost nothing. Joins on fingerprints or buckets take the few keys
with more than 1/HOT of the rows (so fewer than HOT of them) by broadcast and all others by shuffle, where no key is large. A bucket of up to `block` fingerprints compares
its pairs; in a larger one every fingerprint is dealt to centres instead, each of which links its own by a star in linear
space. For an even radius the centres are the points within radius/2 bits: two fingerprints share one exactly if they
are within the radius. For an odd one they are the edges between neighbouring points with an end within (radius-1)/2
bits, by the same reasoning. That is 65 centres a fingerprint for radius 2 and 2,081 for radius 4; a larger radius raises
ValueError, as its centres would be over 40,000. Components come from the stars and pairs.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other; fewer words than a
shingle has form one shingle; documents with a null id get a component but never name it; a component of null ids alone
has a null component id; repeated rows stay repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractloom.llm.common import settle
from tractloom.operators.components import connected_components

SHINGLE = 3
RADIUS = 2
BITS = 64
SEED = 42
BLOCK = 64
HOT = 500
MOST_RADIUS = 4
WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one whole text."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    set_in = np.zeros(BITS, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for a in range(0, len(parts), AT_ONCE):
        h = np.array([hashed(p, SEED) for p in parts[a : a + AT_ONCE]], dtype="<u8")
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(parts), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a bigint (the 64 bits as they are)."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64).view(np.int64))

    return of(text)


def masks(radius: int = RADIUS) -> list[int]:
    """The bits each table keeps, as signed 64-bit numbers."""
    top = (1 << (radius + 1)) - 1
    kept = [sum(1 << i for i in range(BITS) if bin((i % top + 1) & v).count("1") % 2) for v in range(1, top + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def centres(radius: int = RADIUS) -> Column:
    """The centres of column fp, as structs: two fingerprints have one in common exactly if they are within radius."""
    flips = [sum(1 << i for i in at) for k in range(radius // 2 + 1) for at in combinations(range(BITS), k)]
    ball = f"array({', '.join(f'{m - (1 << 64) if m >> 63 else m}L' for m in flips)})"
    if radius % 2:
        edges = "transform(sequence(0, 63), i -> named_struct('point', (fp ^ m) & ~shiftleft(1L, i), 'bit', i))"
        return F.expr(f"flatten(transform({ball}, m -> {edges}))")
    return F.expr(f"transform({ball}, m -> named_struct('point', fp ^ m, 'bit', -1))")


def keyed_join(rows: DataFrame, keys: DataFrame, on: list[str], often: str) -> DataFrame:
    """rows joined with keys (one row for each, `often` being how many rows have it), the frequent keys by broadcast."""
    total = keys.agg(F.sum(often)).first()[0] or 0
    hot = keys.where(F.col(often) * HOT > total)
    if hot.isEmpty():
        return rows.join(keys, on)
    cold = keys.where(F.col(often) * HOT <= total)
    marked = rows.join(F.broadcast(hot.select(*on, F.lit(True).alias("__hot"))), on, "left")
    return marked.where("__hot").drop("__hot").join(F.broadcast(hot), on).unionByName(marked.where("__hot is null").drop("__hot").join(cold, on))


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """a, b: edges that connect exactly what pairs of distinct fingerprints (column fp) within radius connect."""
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"radius must be from 0 to {MOST_RADIUS}, not {radius}")
    tables = F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks(radius))]))
    dealt = fps.select("fp", tables.alias("x")).select("fp", "x.t", "x.key")
    sizes = settle(dealt.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    met = settle(keyed_join(dealt, sizes, ["t", "key"], "n"))
    small = met.where(F.col("n") <= block).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = f"filter(slice(fps, i + 2, size(fps)), y -> bit_count(x ^ y) <= {radius})"
    pairs = small.select(F.explode(F.expr(f"flatten(transform(fps, (x, i) -> transform({near}, y -> named_struct('a', x, 'b', y))))")).alias("e")).select("e.*")
    crowded = met.where(F.col("n") > block).select("fp").distinct().select("fp", F.explode(centres(radius)).alias("c")).select("fp", "c.*")
    heads = crowded.groupBy("point", "bit").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1")
    stars = crowded.join(heads, ["point", "bit"]).where("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """doc_id, fp, component_id for every row of docs."""
    prints = settle(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), shingle).alias("fp")))
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = connected_components(links(distinct.select("fp"), radius, block))
    linked = distinct.join(roots, distinct["fp"] == roots["vertex"]).select("fp", "least", "root")
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    by_root = keyed_join(linked, settle(named), ["root"], "m").select("fp", F.struct("component_id").alias("named"))
    by_print = settle(distinct.join(by_root, "fp", "left").select("fp", F.when(F.col("named").isNotNull(), F.col("named.component_id")).otherwise(F.col("least")).alias("component_id"), "n"))
    return keyed_join(prints, by_print, ["fp"], "n").select("doc_id", "fp", "component_id")


def keep_representatives(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs with one document of each group: the one whose id names the group.

    Rows that repeat an id count as copies, and one of them stays: the least by its text's hash and text, then by all
    columns as text, so reruns keep the same one. Of a group of null ids alone, a row per distinct fingerprint stays; null
    ids in other groups go.
    """
    found = near_duplicates(docs, doc_id=doc_id, text=text, **how)
    ids = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("__kept")).agg(F.count("*").alias("__n"), F.max(F.col("doc_id") == F.col("component_id")).alias("__names"))
    kept = settle(ids.where("__names").select("__kept", "__n"))
    # Ids are small beside texts, so they are hashed and no text is sorted; only rows of repeated ids are ranked.
    named = docs.join(kept.where("__n = 1").hint("shuffle_hash"), F.col(doc_id) == F.col("__kept"), "left_semi")
    repeated = kept.where("__n > 1")
    if not repeated.isEmpty():
        everything = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"})
        of_id = Window.partitionBy(doc_id).orderBy(F.xxhash64(text), text, F.xxhash64(everything), everything)
        ranked = docs.join(repeated, F.col(doc_id) == F.col("__kept"), "left_semi").withColumn("__n", F.row_number().over(of_id))
        named = named.unionByName(ranked.where("__n = 1").drop("__n"))
    lone = found.where("doc_id is null and component_id is null").select(F.col("fp").alias("__fp")).distinct()
    nameless = docs.where(F.col(doc_id).isNull()).withColumn("__f", fingerprint_column(F.col(text), how.get("shingle", SHINGLE)))
    nameless = nameless.join(lone, F.col("__f") == F.col("__fp"), "left_semi").dropDuplicates(["__f"]).drop("__f")
    return named.unionByName(nameless)
