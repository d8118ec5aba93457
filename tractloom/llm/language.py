"""Language ID by prediction by partial matching over bytes, with statistics frozen after one pass over the corpus.

Every language has a context tree of orders 0 to `order` over the UTF-8 bytes, as they are, of its training documents. A
byte seen n times in a context of N bytes, d of them distinct, has probability n / (N + d) there; an unseen one escapes
with d / (N + d) to the next shorter context, at last to equal shares of the 256 bytes (escape method C). As the
statistics are frozen, the code length of every (context, byte) is a constant. The language with the shortest code wins;
the score is its share of the posterior.

The trees are sparse: only the grams (context and byte) that occur are kept, as sorted numbers with the code lengths of
all languages; a gram that none has costs the escape from its context and the shorter gram's code. The order is fixed and
does not depend on the number of languages. All training rows are counted, each partition its own before the shuffle,
in 64-bit integers.

A gram and all its contexts but the empty one have the same last context byte, so the model falls into parts by that byte
that need nothing of each other; the counts of single bytes are small and go with each. Parts are put together up to `max_part_bytes` and broadcast one at a
time; a text's code length is the sum over the parts. Where there is more than one, the documents are read once for each,
and the sums so far are settled between. The smallest part is one context byte of 256.

Defined cases: text that is null, empty or has no letter is `und` with score 0, as is any text when nothing was learnt;
training ignores null texts and null languages; ties go to the first language by code point; repeated rows are learnt
as often as they are; an empty table gives an empty result; an input column named like an output is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import fold_of, settle

ORDER = 3
MAX_PART_BYTES = 200_000_000
CHUNK = 1 << 19
AT_ONCE = 1 << 21
START = b" "
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in LETTER.finditer(text))


def pieces(texts: list[str], order: int):
    """Arrays (grams, numbers of the texts they are of) over whole texts, a chunk of bytes at a time; texts start after spaces."""
    kind = np.uint32 if order <= 3 else np.uint64
    parts, owners, held = [], [], 0

    def out():
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        lengths = np.array([len(p) for p in parts])
        grams = np.zeros(max(len(data) - order, 0), dtype=kind)
        for k in range(order + 1):
            grams = (grams << kind(8)) | data[k : k + len(grams)]
        ends = np.cumsum(lengths)
        keep = np.ones(len(data), dtype=bool)
        for k in range(1, order + 1):
            keep[ends - k] = False
        return grams[keep[: len(grams)]], np.repeat(np.array(owners), lengths - order)

    for i, t in enumerate(texts):
        data = START * order + t.encode("utf-8", "surrogatepass")
        for a in range(0, max(len(data) - order, 1), CHUNK):
            part = data[a : a + CHUNK + order]
            parts.append(part)
            owners.append(i)
            held += len(part)
            if held >= CHUNK:
                yield out()
                parts, owners, held = [], [], 0
    if parts:
        yield out()


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), dtype=bool)


class Part:
    """Code lengths of all grams whose last context byte is one of this part's."""

    def __init__(self, order: int, counts: list[tuple[np.ndarray, np.ndarray]], single: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """counts: of each language, the sorted grams of the highest order and how often they occur; single: of all bytes."""
        self.n = n = len(counts)
        self.order, self.grams, self.bits, self.contexts, self.escapes = order, [], [], [], []
        for k in range(order + 1):
            mask = (1 << 8 * (k + 1)) - 1
            own = single if k == 0 else [added(g & g.dtype.type(mask), c) for g, c in counts]
            grams = np.unique(np.concatenate([g for g, _ in own]))
            contexts, of = np.unique(grams >> grams.dtype.type(8), return_inverse=True)
            bits, escapes = np.empty((len(grams), n), dtype=np.float32), np.empty((len(contexts), n), dtype=np.float32)
            shorter = self.code(grams, k - 1)
            for i, (g, c) in enumerate(own):
                seen = np.zeros(len(grams), dtype=np.int64)
                seen[np.searchsorted(grams, g)] = c
                total = np.bincount(of, weights=seen, minlength=len(contexts))
                whole = total + np.bincount(of, weights=seen > 0, minlength=len(contexts))
                kinds = whole - total
                with np.errstate(divide="ignore", invalid="ignore"):
                    escapes[:, i] = np.where(total > 0, np.log2(whole) - np.log2(kinds), 0)
                    bits[:, i] = np.where(seen > 0, np.log2(whole[of]) - np.log2(seen), escapes[of, i] + shorter[:, i])
            self.grams.append(grams)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escapes.append(escapes)

    def code(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Bits of grams (whatever comes before their last k + 1 bytes) in contexts of k bytes, a column for each language."""
        if k < 0:
            return np.full((len(grams), self.n), 8.0, dtype=np.float32)
        own = grams & grams.dtype.type((1 << 8 * (k + 1)) - 1)
        at, there = find(self.grams[k], own)
        out = self.bits[k][at]
        gone = np.flatnonzero(~there)
        if len(gone):
            rest = own[gone]
            where, known = find(self.contexts[k], rest >> rest.dtype.type(8))
            out[gone] = np.where(known[:, None], self.escapes[k][where], 0) + self.code(rest, k - 1)
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    order: int
    counts: DataFrame | None  # language number, last context byte, gram, n
    single: list[tuple[np.ndarray, np.ndarray]]  # of each language, its bytes and how often they occur
    parts: list[list[int]]  # the context bytes of each part

    def part(self, number: int) -> Part:
        """A part, with what its bound lets onto the driver."""
        own = self.counts.where(F.col("last").isin(self.parts[number])).groupBy("language", "last", F.shiftright("gram", 14).alias("run"))
        packed = own.agg(F.collect_list(F.struct("gram", "n")).alias("x")).select("language", F.col("x.gram").alias("gram"), F.col("x.n").alias("n"))  # at most 16384 grams each
        grams: list[list] = [[] for _ in self.languages]
        counts: list[list] = [[] for _ in self.languages]
        for r in packed.toLocalIterator():
            grams[r.language].append(np.array(r.gram, dtype=np.int64))
            counts[r.language].append(np.array(r.n, dtype=np.int64))
        kind = np.uint32 if self.order <= 3 else np.uint64
        none = [np.zeros(0, dtype=np.int64)]
        return Part(self.order, [added(np.concatenate(g or none).astype(kind), np.concatenate(c or none)) for g, c in zip(grams, counts, strict=True)], self.single)


def fit_languages(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", folds: int = 4, hidden: int = 2, order: int = ORDER, max_part_bytes: int = MAX_PART_BYTES
) -> LanguageModel:
    """The model from all rows with a language whose fold is not the hidden one; a null id is in no fold and not used."""
    if not 1 <= order <= 6:
        raise ValueError("order is 1 to 6")
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (fold_of(F.col(doc_id), folds) != hidden)).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches):
        held: dict[str, list] = {}

        def rows():
            for x, found in held.items():
                grams, n = added(np.concatenate([g for g, _ in found]), np.concatenate([c for _, c in found]))
                for a in range(0, len(grams), 100_000):
                    part = grams[a : a + 100_000].astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(part)), "gram": part, "n": n[a : a + 100_000]})
            held.clear()

        size = 0
        for b in batches:
            by: dict[str, list[str]] = {}
            for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(x, []).append(t)
            for x, texts in by.items():
                for grams, _ in pieces(texts, order):
                    keys, n = np.unique(grams, return_counts=True)
                    found = held.setdefault(x, [])
                    found.append((keys, n.astype(np.int64)))
                    size += len(keys)
                    if len(found) > 8:  # fold what repeats
                        one = added(np.concatenate([g for g, _ in found]), np.concatenate([c for _, c in found]))
                        size += len(one[0]) - sum(len(g) for g, _ in found)
                        held[x] = [one]
                    if size > AT_ONCE:
                        yield from rows()
                        size = 0
        yield from rows()

    counted = settle(known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], order, None, [], [])
    names = docs.sparkSession.createDataFrame(list(enumerate(languages)), "language int, lang string")
    counts = counted.join(F.broadcast(names), "lang").select("language", F.shiftright("gram", 8).bitwiseAND(255).cast("int").alias("last"), "gram", "n")
    # What a part holds for each gram of each order: a row of code lengths, one of escapes at most, and what finds them.
    shorter = [F.count_distinct(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))).alias(f"n{k}") for k in range(order + 1)]
    size = {r["last"]: sum(r[1:]) * (8 * len(languages) + 16) for r in counts.groupBy("last").agg(*shorter).collect()}
    parts: list[list[int]] = []
    room = 0
    for last in sorted(size):
        if not parts or size[last] > room:
            parts.append([])
            room = max_part_bytes
        parts[-1].append(last)
        room -= size[last]
    bytes_of: list[dict] = [{} for _ in languages]
    for r in counts.groupBy("language", F.col("gram").bitwiseAND(255).alias("byte")).agg(F.sum("n").alias("n")).collect():
        bytes_of[r.language][r.byte] = r.n
    kind = np.uint32 if order <= 3 else np.uint64
    single = [added(np.array(list(x), dtype=kind), np.array(list(x.values()), dtype=np.int64)) for x in bytes_of]
    return LanguageModel(languages, order, counts, single, parts)


def add_bits(docs: DataFrame, model: LanguageModel, number: int, text: str, column: str) -> DataFrame:
    """docs with the code lengths of one part's grams, a number for each language, added to `column`."""
    held = docs.sparkSession.sparkContext.broadcast(model.part(number))
    own = np.zeros(256, dtype=bool)
    own[model.parts[number]] = True
    if number == len(model.parts) - 1:  # context bytes never learnt cost the same in all languages, so any part may have them
        own[[b for b in range(256) if not any(b in p for p in model.parts)]] = True
    n, order, everything = len(model.languages), model.order, bool(own.all())

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array, before: pa.Array) -> pa.Array:
        rows = [i for i, t in enumerate(texts) if t.is_valid and has_letter(t.as_py())]
        out = np.zeros((len(texts), n))
        for grams, owners in pieces([texts[i].as_py() for i in rows], order):
            if not everything:
                mine = own[(grams >> grams.dtype.type(8)) & grams.dtype.type(255)]
                grams, owners = grams[mine], owners[mine]
            for a in range(0, len(grams), 1 << 17):
                bits, of_text = held.value.code(grams[a : a + (1 << 17)], order), owners[a : a + (1 << 17)]
                first = np.flatnonzero(np.concatenate(([True], of_text[1:] != of_text[:-1])))
                sums = np.add.reduceat(bits, first, axis=0, dtype=np.float64)
                np.add.at(out, np.array(rows)[of_text[first]], sums)
        old = [x.as_py() for x in before]
        has = set(rows)
        return pa.array([(out[i] if old[i] is None else out[i] + np.array(old[i])).tolist() if i in has else None for i in range(len(texts))], type=pa.list_(pa.float64()))

    return docs.withColumn(column, of(F.col(text), F.col(column)))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """docs with the predicted language and its score; without a shuffle, and in one pass for a model of one part."""
    made = docs.withColumn("__bits", F.lit(None).cast("array<double>"))
    for k in range(len(model.parts)):
        made = add_bits(made, model, k, text, "__bits")
        if k < len(model.parts) - 1:
            made = settle(made)
    least = F.array_min("__bits")
    share = F.lit(1.0) / F.aggregate("__bits", F.lit(0.0), lambda s, x: s + F.pow(F.lit(2.0), F.greatest(least - x, F.lit(-1000.0))))
    named = F.element_at(F.array(*[F.lit(x) for x in model.languages or ["und"]]), F.array_position("__bits", least).cast("int"))
    return made.withColumn(lang_out, F.when(F.col("__bits").isNotNull(), named).otherwise(F.lit("und"))).withColumn(score_out, F.when(F.col("__bits").isNotNull(), share).otherwise(F.lit(0.0))).drop("__bits")
