"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

STATISTICS are shapes of a whole text (rates of character kinds, repetition, word and line lengths), none of them a
word or an id. Standardised by the sample's moments, they are mapped to cosines whose products approximate a Gaussian
kernel. Every partition of the sample sums its part of the normal equations, the sums are added and solved, and a held
back quarter of the sample calibrates the ridge scores by pool-adjacent-violators.

The sample is at most `most` labelled documents (20,000), those of the smallest id hashes; scoring covers every row.

Defined cases: null text counts as empty, and an empty text gets the score of its statistics (all 0); with no labelled
row the score is 0.5, with one class alone that class; repeated rows score alike; an empty table gives an empty result;
an input column named like the score is replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import labelled_sample, settle

MOST_LABELLED = 20_000
FEATURES = 192
RIDGE = 1e-3
FIT_PARTS = 8
STATISTICS = (
    "log_words", "word_length", "word_length_spread", "distinct_words", "distinct_pairs", "same_as_last", "top_word", "upper", "digits", "space",
    "stops", "commas", "bars", "bangs", "marks", "lines", "distinct_lines", "short_words", "long_words", "non_ascii", "ends_marked", "log_chars",
)
MARKS = b"&*$%#@^~<>=_+\\/{}[]"


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    rate = lambda chars: float(kinds[np.frombuffer(chars, dtype=np.uint8)].sum()) / n
    return [
        np.log1p(n), lengths.mean(), lengths.std(), len(counts) / n**0.8, len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        sum(map(bytes.__eq__, words, words[1:])) / n, max(counts.values()) / n, float(kinds[65:91].sum()) / size, float(kinds[48:58].sum()) / size,
        rate(b" \t\n") , rate(b".?"), rate(b",;:"), rate(b"|"), rate(b"!"), rate(MARKS), len(lines) / n, len(set(lines)) / len(lines),
        float((lengths <= 2).mean()), float((lengths >= 12).mean()), float(kinds[128:].sum()) / size, float(sum(w[-1] in MARKS for w in words)) / n, np.log1p(size),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        """A constant, the standardised statistics, and the random cosines."""
        x = np.clip((stats - self.mean) / self.scale, -5, 5)
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.waves + self.phases)
        return np.hstack([np.ones((len(x), 1)), x, z])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(stats):
            return np.full(len(stats), self.steps[1][0])
        return np.interp(self.features(stats) @ self.weights, *self.steps)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ends and heights of the increasing step function nearest to y over x."""
    pools: list[list[float]] = []
    for value, label in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        pools.append([value, value, label, 1.0])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            top = pools.pop()
            pools[-1] = [pools[-1][0], top[1], pools[-1][2] + top[2], pools[-1][3] + top[3]]
    at = np.array([v for p in pools for v in p[:2]])
    # One pseudo-row of the mean label in every pool keeps scores off 0 and 1.
    prior = y.mean()
    return at, np.repeat([(p[2] + prior) / (p[3] + 1) for p in pools], 2)


def add_statistics(docs: DataFrame, text: str, name: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in texts.to_pylist()], type=pa.list_(pa.float64()))

    return docs.withColumn(name, of(F.col(text)))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 4, hidden: int = 2, doc_id: str = "doc_id", text: str = "text",
    most: int = MOST_LABELLED, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7,
) -> QualityModel:
    """The model; only rows whose fold is not the hidden one are learnt from."""
    known = labels.where(F.col(label).isNotNull())
    counts = {r.v: r.n for r in known.groupBy(F.col(label).alias("v")).agg(F.count("*").alias("n")).collect()}  # two rows
    share = min(1.0, most / max(sum(counts.values()), 1))
    sample = labelled_sample(docs, labels, label, most={v: max(int(n * share), 1) for v, n in counts.items()} or {1: 1}, folds=folds, hidden=hidden, doc_id=doc_id, text=text)
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(4)) == 0
    sample = settle(add_statistics(sample, "text", "stats").select("label", held.alias("held"), "stats").repartition(FIT_PARTS))
    d = len(STATISTICS)
    rng = np.random.default_rng(seed)
    waves, phases = rng.normal(size=(d, features)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, features)

    def moments(batches):
        total = np.zeros((2, d + 1))
        for b in batches:
            if b.num_rows:
                x = np.array(b.column(0).to_pylist())
                total += np.vstack([np.append(x.sum(axis=0), len(x)), np.append((x**2).sum(axis=0), b.column(1).to_numpy().sum())])
        yield pa.RecordBatch.from_pydict({"m": [total.ravel().tolist()]})

    m = sum((np.array(r.m).reshape(2, -1) for r in sample.select("stats", F.col("label").cast("double").alias("label")).mapInArrow(moments, "m array<double>").collect()), np.zeros((2, d + 1)))
    n, ones = m[0, -1], m[1, -1]
    mean = m[0, :-1] / max(n, 1)
    scale = np.sqrt(np.maximum(m[1, :-1] / max(n, 1) - mean**2, 1e-8))
    model = QualityModel(mean, scale, waves, phases, None, (np.zeros(1), np.array([ones / n if n else 0.5])))
    if not 0 < ones < n:
        return model

    def normal_equations(batches):
        k = 1 + d + features
        gram = np.zeros((k, k + 1))
        for b in batches:
            if b.num_rows:
                z = model.features(np.array(b.column(0).to_pylist()))
                gram[:, :k] += z.T @ z
                gram[:, k] += z.T @ b.column(1).to_numpy()
        yield pa.RecordBatch.from_pydict({"g": [gram.tobytes()]})

    fit = sample.where("not held").select("stats", F.col("label").cast("double").alias("label"))
    k = 1 + d + features
    gram = sum((np.frombuffer(r.g).reshape(k, k + 1) for r in fit.mapInArrow(normal_equations, "g binary").collect()), np.zeros((k, k + 1)))  # FIT_PARTS matrices
    solved = np.linalg.solve(gram[:, :k] + ridge * max(n, 1) * np.diag([1e-6] + [1e-2] * d + [1.0] * features), gram[:, k])
    model.weights = solved
    back = sample.where("held").select("stats", "label").collect()  # a quarter of the bounded sample
    if len({r.label for r in back}) < 2:
        back = sample.select("stats", "label").collect()
    model.steps = isotonic(model.features(np.array([r.stats for r in back])) @ solved, np.array([float(r.label) for r in back]))
    return model


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", out: str = "quality_score") -> DataFrame:
    """docs with `out`, the probability of label 1, in one pass and without a shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(held.value.scores(np.array([statistics(t) for t in texts.to_pylist()]).reshape(-1, len(STATISTICS))))

    return docs.withColumn(out, of(F.col(text)))
