"""Benchmark decontamination: find test-item word windows in training documents and remove the spans or the documents.

Words are the maximal runs of bytes that are neither ASCII punctuation nor ASCII space, after lower-casing A-Z. Every
benchmark item gives its windows of `window` consecutive words; an item of fewer words, but not none, is one window.
The windows form a hash set that is broadcast while their number is within a checked bound; beyond it the same windows are
joined by a shuffle on their hash, after a Bloom filter of them has let few others of the documents' windows through.
Either way a hash match counts only after the words themselves were compared.

The broadcast set is three sorted arrays (hash, where the window starts among all items' words, and the item), so it takes
some 20 bytes a window besides the items' vocabulary.

Defined cases: a null or wordless text has 0 words and no hit; a null or wordless item is never hit, and an item without an
id is none; items that share a window are all reported; repeated documents are judged one by one; an empty table gives an empty result; an input column
named like the outcome is replaced; other extra columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import settle

WINDOW = 13
MAX_BROADCAST_WINDOWS = 4_000_000
MAX_BLOOM_BITS = 1 << 29
OUTCOME = "struct<n_words:bigint,n_hit:bigint,item_ids:array<string>,spans:array<struct<start:int,end:int>>>"
ARROW_OUTCOME = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
)
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
WORD_TEXT = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
MULTIPLIER = 0x9E3779B97F4A7C15


@dataclass
class WindowIndex:
    """Benchmark windows by length. Words are numbered from 1; 0 stands for every word that no item has."""

    numbers: dict[bytes, int]
    powers: np.ndarray
    words: np.ndarray  # the numbers of all items' words, one item after the other
    hashes: dict[int, np.ndarray]  # by length, sorted
    starts: dict[int, np.ndarray]  # where the window of a hash starts in words
    owners: dict[int, np.ndarray]  # the place of its item in names
    names: list[str]

    @classmethod
    def build(cls, rows: list[tuple[str, str | None]], window: int) -> WindowIndex:
        numbers: dict[bytes, int] = {}
        powers = np.cumprod(np.full(window, MULTIPLIER, dtype=np.uint64), dtype=np.uint64)
        names, parts, at = [], [], 0
        found: dict[int, list[tuple]] = {}
        for item, text in rows:
            words = WORD_BYTES.findall((text or "").encode("utf-8", "surrogatepass").lower())
            if not words:
                continue
            ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.uint32)
            n = min(window, len(words))
            hashes = (np.lib.stride_tricks.sliding_window_view(ids, n) * powers[:n]).sum(axis=1, dtype=np.uint64)
            found.setdefault(n, []).append((hashes, at + np.arange(len(hashes)), np.full(len(hashes), len(names), dtype=np.int32)))
            names.append(item)
            parts.append(ids)
            at += len(ids)
        index = cls(numbers, powers, np.concatenate(parts or [np.zeros(0, dtype=np.uint32)]), {}, {}, {}, names)
        for n, some in found.items():
            hashes, starts, owners = (np.concatenate([x[k] for x in some]) for k in range(3))
            order = np.argsort(hashes, kind="stable")
            index.hashes[n], index.starts[n], index.owners[n] = hashes[order], starts[order], owners[order]
        return index

    def items_of(self, n: int, place: int, ids: np.ndarray) -> list[str]:
        """The items whose window of this hash has these words."""
        hashes, out = self.hashes[n], []
        h = hashes[place]
        while place < len(hashes) and hashes[place] == h:
            a = self.starts[n][place]
            if (self.words[a : a + n] == ids).all():
                out.append(self.names[self.owners[n][place]])
            place += 1
        return out

    def scan(self, text: str | None) -> dict:
        """Words, hit words, items and hit spans (code points of the text as given) of one whole document."""
        words = WORD_BYTES.findall((text or "").encode("utf-8", "surrogatepass").lower())
        ids = np.array(list(map(self.numbers.get, words, [0] * len(words))), dtype=np.uint64)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        edges, items = None, set()
        for n, hashes in self.hashes.items():
            if n > len(words):
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            h = np.zeros(len(at), dtype=np.uint64)
            for j in range(n):
                h += ids[at + j] * self.powers[j]
            place = np.searchsorted(hashes, h)
            there = hashes[np.minimum(place, len(hashes) - 1)] == h
            for i, p in zip(at[there].tolist(), place[there].tolist(), strict=True):
                found = self.items_of(n, p, ids[i : i + n])  # the exact check
                if found:
                    if edges is None:
                        edges = np.zeros(len(words) + 1, dtype=np.int64)
                    edges[i] += 1
                    edges[i + n] -= 1
                    items.update(found)
        if edges is None:
            return {"n_words": len(words), "n_hit": 0, "item_ids": [], "spans": []}
        hit = np.cumsum(edges[:-1]) > 0
        places = [m.span() for m in WORD_TEXT.finditer(text)]
        turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        spans = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(turns[::2], turns[1::2], strict=True)]
        return {"n_words": len(words), "n_hit": int(hit.sum()), "item_ids": sorted(items), "spans": spans}


def scan_by_broadcast(docs: DataFrame, rows: list[tuple[str, str | None]], text: str, window: int, outcome: str) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex.build(rows, window))

    @F.arrow_udf(OUTCOME)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([index.value.scan(t) for t in texts.to_pylist()], type=ARROW_OUTCOME)

    return docs.withColumn(outcome, scan(F.col(text)))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(c, F.lit(""))), F.lit("([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+)"), 1)


def bloom(windows: DataFrame, n: int):
    """A test of whether a hash may be among those of windows (column h), as a function of a column.

    Two bits of a bitmap of 16 bits a window, up to MAX_BLOOM_BITS (64 MB). Each partition sets the bits of its own hashes
    and passes on the pages of the map that it touched, so what reaches the driver is one map.
    """
    bits = 1 << min(max(int(16 * max(n, 1)).bit_length(), 16), MAX_BLOOM_BITS.bit_length() - 1)
    page = 1 << 13

    def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = h.view(np.uint64)
        return (u & np.uint64(bits - 1)).astype(np.int64), (u >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64)

    def pages(batches):
        own: dict[int, np.ndarray] = {}
        for b in batches:
            for at in places(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)):
                for p in np.unique(at >> 16):
                    held = own.setdefault(int(p), np.zeros(page, dtype=np.uint8))
                    inside = at[at >> 16 == p] & 0xFFFF
                    np.bitwise_or.at(held, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        for p, held in own.items():
            yield pa.RecordBatch.from_pydict({"page": pa.array([p], pa.int32()), "held": pa.array([held.tobytes()], pa.binary())})

    filled = np.zeros(max(bits >> 3, page), dtype=np.uint8)
    for r in windows.select("h").mapInArrow(pages, "page int, held binary").toLocalIterator():
        filled[r.page * page : (r.page + 1) * page] |= np.frombuffer(bytes(r.held), dtype=np.uint8)
    held = windows.sparkSession.sparkContext.broadcast(filled)

    @F.arrow_udf("boolean")
    def test(h: pa.Array) -> pa.Array:
        a, b = places(h.to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.array((held.value[a >> 3] >> (a & 7) & held.value[b >> 3] >> (b & 7) & 1).astype(bool))

    return test


def scan_by_shuffle(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, outcome: str) -> DataFrame:
    """The way beyond the broadcast bound: windows of both sides meet in a shuffle on hash and length.

    Documents are known by a hash of their text, as equal texts have equal hits. Spans are counted in words here and
    turned to code points from the text at the end.
    """
    windows = (
        items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("w"))
        .where(F.size("w") > 0)
        .select("item", F.least(F.size("w"), F.lit(window)).alias("n"), "w")
        .select("item", "n", F.explode(F.expr("transform(sequence(1, size(w) - n + 1), i -> slice(w, i, n))")).alias("part"))
        .groupBy("n", "part")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("h", F.xxhash64("part"))
    )
    windows = settle(windows)
    by_length = {r.n: r.k for r in windows.groupBy("n").agg(F.count("*").alias("k")).collect()}  # at most `window` numbers
    lengths, may_be = sorted(by_length), bloom(windows, sum(by_length.values()))
    named = docs.withColumn("__words", words_of(F.col(text))).withColumn("__key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    spread = None
    for n in lengths:
        part = named.where(F.size("__words") >= n).dropDuplicates(["__key"]).select(
            "__key", F.lit(n).alias("n"), F.posexplode(F.expr(f"transform(sequence(1, size(__words) - {n} + 1), i -> slice(__words, i, {n}))")).alias("at", "part")
        )
        spread = part if spread is None else spread.unionByName(part)
    if spread is None:
        empty = F.from_json(F.lit('{"n_hit":0,"item_ids":[],"spans":[]}'), OUTCOME)
        return named.withColumn(outcome, empty.withField("n_words", F.size("__words").cast("long"))).drop("__words", "__key")
    hits = (
        spread.withColumn("h", F.xxhash64("part"))
        .where(may_be(F.col("h")))
        .join(windows, ["h", "n", "part"])
        .groupBy("__key")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("found"), F.collect_set(F.struct("at", "n")).alias("runs"))
    )

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def to_spans(texts: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            places = [m.span() for m in WORD_TEXT.finditer(t)] if r else []
            edges = np.zeros(len(places) + 1, dtype=np.int64)
            for x in r or ():
                edges[x["at"]] += 1
                edges[x["at"] + x["n"]] -= 1
            turns = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]))))
            out.append([{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(turns[::2], turns[1::2], strict=True)])
        return pa.array(out, type=ARROW_OUTCOME.field("spans").type)

    n_hit = F.expr("size(array_distinct(flatten(transform(runs, r -> sequence(r.at, r.at + r.n - 1)))))").cast("long")
    made = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.coalesce(F.when(F.col("runs").isNotNull(), n_hit), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("found", F.array().cast("array<string>")).alias("item_ids"),
        to_spans(F.col(text), F.col("runs")).alias("spans"),
    )
    return named.join(hits, "__key", "left").withColumn(outcome, made).drop("__words", "__key", "found", "runs")


def find_contamination(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    outcome: str = "contamination", max_broadcast_windows: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """docs with a struct column `outcome`: n_words, n_hit, item_ids (sorted as text), spans (code points of the text)."""
    named = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("__item"), F.col(item_text).alias("__text"))
    # A word is a letter and what parts it from the next, so an item has at most half as many words and windows as bytes.
    most = named.select(F.sum(F.octet_length("__text") / 2 + 1).alias("n")).first().n or 0
    if most > max_broadcast_windows:
        most = named.select(F.sum(F.size(words_of(F.col("__text")))).alias("n")).first().n or 0
    if most <= max_broadcast_windows:
        return scan_by_broadcast(docs, [(r[0], r[1]) for r in named.collect()], text, window, outcome)
    return scan_by_shuffle(docs, named, text, "__item", "__text", window, outcome)


def is_contaminated(outcome: str = "contamination") -> Column:
    """The rule of rejection: at least one word in twenty is hit."""
    o = F.col(outcome)
    return (o["n_hit"] > 0) & (20 * o["n_hit"] >= o["n_words"])


def drop_documents(found: DataFrame, outcome: str = "contamination") -> DataFrame:
    """Without the contaminated documents and without the outcome."""
    return found.where(~is_contaminated(outcome)).drop(outcome)


def remove_spans(found: DataFrame, text: str = "text", outcome: str = "contamination") -> DataFrame:
    """Every document stays; its hit spans are cut out of the text."""
    s, t = f"`{outcome}`.spans", f"`{text}`"
    kept = F.expr(f"concat(aggregate({s}, named_struct('a', 0, 't', ''), (s, x) -> named_struct('a', x.end, 't', concat(s.t, substring({t}, s.a + 1, x.start - s.a))), s -> s.t), substring({t}, element_at({s}, -1).end + 1))")
    return found.withColumn(text, F.when(F.size(F.col(outcome)["spans"]) > 0, kept).otherwise(F.col(text))).drop(outcome)
