"""Importance resampling towards a target corpus: hashed word and word-pair counts of both, and a seeded weighted draw.

Texts are lower-cased in A-Z only and cut by an untrained pre-tokeniser, a Split on a pattern, which gives each word with
its offsets. Windows of one and of two neighbouring offsets are the features; the crc32 of a feature's bytes names its
bucket. Bucket counts are summed in each task before they are shuffled; a bucket's gain compares its share in the target
with that in the corpus, and a document's weight is the floored mean gain of its features. Among the documents long enough, a share is
drawn without replacement by adding to each weight a Gumbel number of its own, taken from a hash of its id.

The buckets of each document are written once, two bytes a feature, so no text is cut twice. Only the gains, one number
a bucket, pass the driver.

Defined cases: a null or empty text has no feature, weight 0 and is too short to be drawn; the hash of a null id is that of
an empty one; among equal scores null ids come first, then the smaller; rows equal in score and id are rows of their own, any of
them first; an empty corpus gives an empty result, an empty target gains from counts of 0; further columns come along
only if named in `keep`, which may not name a column that is made here.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from tractloom.llm.common import settle
from tractloom.llm.ordering import placed

BUCKETS = 10_000
MOST_BUCKETS = 1 << 16  # two bytes each
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
KNOWN_WORDS = 100_000  # words whose codes a task remembers at once
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


class Cutter:
    """Texts to the buckets of their features, in the order of words, then of pairs."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.split, self.codes = buckets, splitter(), {}

    def code(self, word: str) -> tuple[bytes, int, int]:
        """A word's bytes, its crc32, and that with a space after it, from which a pair goes on."""
        found = self.codes.get(word)
        if found is None:
            if len(self.codes) >= KNOWN_WORDS:
                self.codes.clear()
            octets = word.encode()
            crc = zlib.crc32(octets)
            found = self.codes[word] = (octets, crc, zlib.crc32(b" ", crc))
        return found

    def __call__(self, text: str | None) -> bytes:
        low = (text or "").encode().lower().decode()  # bytes.lower changes A-Z alone
        spans = [span for _, span in self.split.pre_tokenize_str(low)]
        words = [self.code(low[a:b]) for a, b in spans]
        pairs = [zlib.crc32(after[0], before[2]) for before, after in zip(words, words[1:], strict=False)]
        return (np.array([w[1] for w in words] + pairs, np.uint32) % self.buckets).astype("<u2").tobytes()


def feature_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Binary: a little-endian unsigned 16-bit bucket for each feature."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets")

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        cut = Cutter(buckets)
        return pa.array([cut(t.as_py()) for t in texts], pa.binary())

    return of(text)


def histogram(cut: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n over all rows: each task sends its own sums, a row for each bucket it met."""

    def sums(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for octets in b.column(0):
                if octets.is_valid:
                    total += np.bincount(np.frombuffer(octets.as_buffer(), "<u2"), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    return cut.select(column).mapInArrow(sums, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for counts s of the corpus, t of the target."""
    spark = corpus.sparkSession
    s, t = (h.select("bucket", F.col("n").cast("double").alias(name)) for h, name in ((corpus, "s"), (target, "t")))
    sums = [h.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for h in (corpus, target)]
    all_s, all_t = (F.lit(float(x + buckets)) for x in sums)
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").fillna(0.0, ["s", "t"])
    ratio = ((F.col("t") + 1) * all_s) / ((F.col("s") + 1) * all_t)
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def weigh(features: Column, gain: np.ndarray) -> Column:
    """The floored mean of the gains of a document's features, 0 for none."""

    @F.arrow_udf("bigint")
    def of(cut: pa.Array) -> pa.Array:
        own = (np.frombuffer(c.as_buffer(), "<u2") for c in cut)
        return pa.array([int(gain[f].sum()) // len(f) if len(f) else 0 for f in own], pa.int64())

    return of(features)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) for the u in (0, 1) that the first 32 bits of sha256("seed:id") give."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_features, weight, score, rank and the columns of `keep`; rank is 1, 2, 3... of those drawn, else null."""
    if clash := {"doc_id", "n_features", "weight", "score", "rank"} & set(keep):
        raise ValueError(f"keep names columns that are made here: {sorted(clash)}")
    cut = settle(docs.select(F.col(doc_id).alias("doc_id"), *keep, feature_buckets(F.col(text), buckets).alias("__cut")))
    aim = target.select(feature_buckets(F.col(target_text), buckets).alias("__cut"))
    corpus = settle(histogram(cut, "__cut", buckets))
    gain = np.zeros(buckets, np.int64)  # one number a bucket: at most MOST_BUCKETS
    for bucket, value in gains(corpus, settle(histogram(aim, "__cut", buckets)), buckets).collect():
        gain[bucket] = value
    scored = cut.withColumn("n_features", (F.octet_length("__cut") / 2).cast("long")).withColumn("weight", weigh(F.col("__cut"), gain)).drop("__cut")
    scored = settle(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    # w words give w features of one and w - 1 of two.
    long_enough = F.col("n_features") >= 2 * least_words - 1 if least_words > 0 else F.lit(True)
    eligible = scored.where(long_enough).withColumn("__down", -F.col("score"))
    order = placed(eligible, ["__down", "doc_id"], rank="__place")
    drawn = percent * eligible.count() // 100
    ranked = order.select("doc_id", "n_features", "weight", "score", F.when(F.col("__place") < drawn, F.col("__place") + 1).alias("rank"), *keep)
    return ranked.unionByName(scored.where(~long_enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"), *keep))
