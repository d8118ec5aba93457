"""Toxicity: a weighted finite-state grammar over clauses, its lexicon and calibration learnt from labels.

Transducers are states and arcs (input, output, weight, next state); weights add up along a path, in logarithms of odds.
The lexical one reads the letters of a word and gives its class: insult (with a learnt weight), threat, target, negation,
report, or a plain word. Four more read the classes of a clause and are composed into one machine:

* negation: an insult or threat within NEGATION_REACH words after a negation is marked and weighs less;
* reported speech: in a clause with a speech verb, or quoted from one, every hit is marked and weighs less;
* target: in a clause with a target word, before or after the hit, every hit is marked and weighs more;
* threat: a threat beside a target weighs THREAT_WEIGHT, any other is a plain word.

The machines of report and target guess at the start whether such a word will come and accept only if that was right, so
a clause has exactly one accepted path; its weight and marked hits are those of the clause. A document is scored from its
matched clauses, never from its other words. Insults are stems learnt from labelled documents: a path of letters whose
documents are toxic far more often than chance, as far as all its supporting words agree, so an open ending stands for
every ending. Threats, targets, negations and speech verbs are the fixed words below.

The sample is at most `most` labelled documents of each label (twice that of clean ones), of the smallest id hashes, one
of each text sketch, so that copies of one document do not make its words look toxic. The chance of a stem's counts is
bounded (Chernoff), and stems are taken as long as at most FALSE_SHARE of those taken are expected to be by chance
(Benjamini and Hochberg), so a rare insult of a small language counts like any other; there is no floor by share and no
limit on stems. Stems are read up to MAX_STEM letters, and whole words of
any length. Scoring covers every row and every whole text.

Defined cases: null and empty texts match nothing and get the score of no match; with no toxic or no clean label that
score is 0; repeated rows score alike; an empty table gives an empty result; an input column named like an output is
replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import cache, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import labelled_sample, settle

MOST_LABELLED = 6_000
MIN_STEM, MAX_STEM = 3, 32
MIN_DOCUMENTS, FALSE_SHARE = 3, 0.05
NEGATION_REACH = 3
AT_ONCE = 500_000
WORDS_KEPT = 50_000
# Closed word classes in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself du dich dir dein deine ihr euch sie tu toi te ton ta vous votre tú ti usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca ningún ninguna".split())
REPORTS = frozenset("said says say called calls wrote quoted claims sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split())
THREATS = frozenset("kill hurt destroy murder töten umbringen vernichten tuer détruire frapper matar destruir golpear".split())
NEGATED, REPORTED, TARGETED = -2.0, -1.0, 0.5
THREAT_WEIGHT = 4.0
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
TOKEN = re.compile(r"([^\W\d_]+(?:'[^\W\d_]+)?)|([.!?;:\n\"“”«»])")
END = "$"
HITS = ("insult", "threat")


@dataclass
class Transducer:
    """arcs: (state, input) to [(output, weight, next state)]; one output for one input."""

    starts: list
    finals: set
    arcs: dict[tuple, list[tuple]]

    def compose(self, after: Transducer) -> Transducer:
        """The machine that feeds this one's outputs to `after`."""
        starts = [(a, b) for a in self.starts for b in after.starts]
        by_state = defaultdict(list)
        for (state, symbol), found in self.arcs.items():
            by_state[state].append((symbol, found))
        arcs, todo, known = {}, list(starts), set(starts)
        while todo:
            a, b = todo.pop()
            for symbol, found in by_state[a]:
                out = [(o2, w1 + w2, (n1, n2)) for o1, w1, n1 in found for o2, w2, n2 in after.arcs.get((b, o1), ())]
                if out:
                    arcs[(a, b), symbol] = out
                for _, _, state in out:
                    if state not in known:
                        known.add(state)
                        todo.append(state)
        return Transducer(starts, {s for s in known if s[0] in self.finals and s[1] in after.finals}, arcs)

    def paths(self, symbols: list[str]) -> list[tuple[float, list[str]]]:
        """Weight and outputs of every accepted path. Of paths that meet in a state the heavier goes on."""
        alive = {s: (0.0, None) for s in self.starts}
        for symbol in symbols:
            reached: dict = {}
            for state, (w, back) in alive.items():
                for out, more, to in self.arcs.get((state, symbol), ()):
                    if to not in reached or reached[to][0] < w + more:
                        reached[to] = w + more, (back, out)
            alive = reached
        found = []
        for state, (w, back) in alive.items():
            if state in self.finals:
                outputs = []
                while back is not None:
                    back, out = back
                    outputs.append(out)
                found.append((w, outputs[::-1]))
        return found


def annotated(mark: str) -> list[tuple[str, str]]:
    """Every hit a machine may read, with and without the marks of those before it, and the hit with one more mark."""
    before = {"n": [""], "r": ["", "/n"], "t": ["", "/n", "/r", "/n/r"]}[mark]
    return [(f"{h}{b}", f"{h}{b}/{mark}") for h in HITS for b in before]


PLAIN = ("word", "target", "negation", "report", "quoted")


def negation_machine() -> Transducer:
    arcs = {}
    for left in range(NEGATION_REACH + 1):
        after = max(left - 1, 0)
        for s in PLAIN:
            arcs[left, s] = [(s, 0.0, NEGATION_REACH if s == "negation" else left if s == "quoted" else after)]
        for hit, marked in annotated("n"):
            arcs[left, hit] = [(marked, NEGATED, after) if left else (hit, 0.0, after)]
    return Transducer([0], set(range(NEGATION_REACH + 1)), arcs)


def clause_machine(mark: str, words: tuple[str, ...], weight: float) -> Transducer:
    """Marks and weighs all hits of clauses that have one of the words, wherever it is."""
    arcs = {}
    for state in ("none", "awaited", "met"):
        for s in PLAIN:
            if s not in words:
                arcs[state, s] = [(s, 0.0, state)]
            elif state != "none":
                arcs[state, s] = [(s, 0.0, "met")]
        for hit, marked in annotated(mark):
            arcs[state, hit] = [(hit, 0.0, state) if state == "none" else (marked, weight, state)]
    return Transducer(["none", "awaited"], {"none", "met"}, arcs)


def threat_machine() -> Transducer:
    arcs = {("all", s): [(s, 0.0, "all")] for s in PLAIN}
    marks = [n + r + t for n in ("", "/n") for r in ("", "/r") for t in ("", "/t")]
    for m in marks:
        arcs["all", f"insult{m}"] = [(f"insult{m}", 0.0, "all")]
        threatens = m.endswith("/t")  # what the other machines made of a threat without a target is taken back
        arcs["all", f"threat{m}"] = [(f"threat{m}", THREAT_WEIGHT, "all") if threatens else ("word", -(NEGATED if "/n" in m else 0.0) - (REPORTED if "/r" in m else 0.0), "all")]
    return Transducer(["all"], {"all"}, arcs)


@cache
def machines() -> tuple[Transducer, ...]:
    return negation_machine(), clause_machine("r", ("report", "quoted"), REPORTED), clause_machine("t", ("target",), TARGETED), threat_machine()


@cache
def composed() -> Transducer:
    return reduce(Transducer.compose, machines())


@dataclass
class Lexicon:
    """The lexical transducer: states are paths of letters; a word's class and weight are those of its longest one."""

    stems: dict[str, float]  # a stem ending in END is a whole word

    def __post_init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.out: list[tuple[str, float] | None] = [None]
        for words, name in ((REPORTS, "report"), (NEGATIONS, "negation"), (TARGETS, "target")):
            for w in sorted(words):
                self.add(w + END, (name, 0.0))
        for stem, weight in sorted(self.stems.items()):
            self.add(stem, ("insult", weight))
        for w in sorted(THREATS):
            self.add(w + END, ("threat", 0.0))

    def add(self, path: str, out: tuple[str, float]) -> None:
        state = 0
        for letter in path:
            if letter not in self.arcs[state]:
                self.arcs[state][letter] = len(self.arcs)
                self.arcs.append({})
                self.out.append(None)
            state = self.arcs[state][letter]
        self.out[state] = out

    def read(self, word: str) -> tuple[str, float]:
        state, found = 0, None
        for letter in (*word, END):
            state = self.arcs[state].get(letter)
            if state is None:
                break
            found = self.out[state] or found
        return found or ("word", 0.0)


@dataclass
class Grammar:
    stems: dict[str, float] = field(default_factory=dict)  # a stem ending in END is a whole word
    weights: np.ndarray = field(default_factory=lambda: np.array([-30.0, 0.0, 0.0, 0.0]))
    blank: float = 0.0

    def __post_init__(self) -> None:
        self.finder = self.lexicon = None
        self.known: dict[str, tuple[str, float]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"finder": None, "lexicon": None, "known": {}}

    def may_match(self, low: str) -> bool:
        """Whether a stem or a threat occurs anywhere; without one no clause can match."""
        if self.finder is None:
            self.finder, self.lexicon = ahocorasick.Automaton(), Lexicon(self.stems)
            for s in {s.removesuffix(END) for s in self.stems} | THREATS:
                self.finder.add_word(s, True)
            self.finder.make_automaton()
        return next(self.finder.iter(low), None) is not None

    def lexical(self, word: str) -> tuple[str, float]:
        """Class and weight of a lower-case word."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= WORDS_KEPT:
                self.known.clear()
            found = self.known[word] = self.lexicon.read(word)
        return found

    def clauses(self, text: str | None) -> list[dict]:
        """The matched clauses of a text in order: their weight, matched words and context."""
        low = (text or "").lower()
        if not self.may_match(low):
            return []
        found, words, quoted = [], [], False
        for m in TOKEN.finditer(low + "\n"):
            if m[1]:
                words.append((m[1], *self.lexical(m[1])))
                continue
            kinds = [k for _, k, _ in words]
            reported = quoted or "report" in kinds
            if "insult" in kinds or "threat" in kinds:
                found += self.matched(words, quoted)
            quoted = reported and m[2] in ':"“«'  # a quotation stays reported over its opening mark
            words = []
        return found

    def matched(self, words: list[tuple[str, str, float]], quoted: bool) -> list[dict]:
        """The clause as a list of one, or of none if nothing in it is a hit or its weight is not above 0."""
        (weight, outputs), = composed().paths([*(["quoted"] if quoted else []), *(k for _, k, _ in words)])
        hits = [(w, o) for w, o in zip(words, outputs[quoted:], strict=True) if o.startswith(HITS)]
        weight += sum(w for (_, _, w), _ in hits)
        if not hits or weight <= 0:
            return []
        marks = [o.split("/")[1:] for _, o in hits]
        return [{"weight": weight, "words": [w for (w, _, _), _ in hits], "negated": any("n" in m for m in marks), "reported": "r" in marks[0], "targeted": "t" in marks[0]}]

    def features(self, text: str | None) -> list[float]:
        """1, summed weight of clauses, matched clauses, distinct matched words (all by logarithm)."""
        c = self.clauses(text)
        return [1.0, np.log1p(sum(x["weight"] for x in c)), np.log1p(len(c)), np.log1p(len({w for x in c for w in x["words"]}))]

    def score(self, text: str | None) -> float:
        f = self.features(text)
        if not f[1]:
            return self.blank
        return float(1 / (1 + np.exp(-np.clip(np.dot(f, self.weights), -30, 30))))


def sketch(words: list[str], k: int = 5) -> int:
    """A hash of the three smallest hashes of k-word shingles: the same for copies, mostly so for near copies."""
    parts = {" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))}
    least = sorted(xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 3) for p in parts)[:3]
    return xxhash.xxh64_intdigest(repr(least)) >> 1


def stem_counts(sample: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """stem, n: documents (column words) that have the stem, of the stems whose xxhash64 is in `only` if given.

    Each partition counts before the shuffle, and passes its counts on when there are AT_ONCE of them.
    """
    held = None if only is None else sample.sparkSession.sparkContext.broadcast(only)

    def rows(tally: dict[str, int]):
        stems = list(tally)
        for a in range(0, len(stems), 50_000):
            part = stems[a : a + 50_000]
            if held is not None:
                hashes = np.array([xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in part], dtype=np.uint64).view(np.int64)
                part = [part[i] for i in np.flatnonzero(np.isin(hashes, held.value))]
            yield pa.RecordBatch.from_pydict({"stem": pa.array(part, pa.string()), "n": pa.array([tally[s] for s in part], pa.int64())})

    def count(batches):
        tally: dict[str, int] = {}
        for b in batches:
            for words in b.column(0):
                for s in {(w + END)[:n] for w in words.as_py() for n in (*range(MIN_STEM, min(len(w) + 1, MAX_STEM) + 1), len(w) + 1)}:
                    tally[s] = tally.get(s, 0) + 1
                if len(tally) > AT_ONCE:
                    yield from rows(tally)
                    tally.clear()
        yield from rows(tally)

    return sample.select("words").mapInArrow(count, "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))


def surprise(toxic: int, clean: int, share: float) -> float:
    """By the Chernoff bound, e to the minus this is more than the chance of so many toxic documents if `share` of all are."""
    n = toxic + clean
    if toxic <= n * share:
        return 0.0
    return toxic * float(np.log(toxic / (n * share))) + (clean * float(np.log(clean / (n * (1 - share)))) if clean else 0.0)


def surprise_column(toxic: Column, clean: Column, share: float) -> Column:
    """surprise() as a column."""
    n = toxic + clean
    rare = F.when(clean > 0, clean * F.ln(clean / (n * (1 - share)))).otherwise(0.0)
    return F.when(toxic > n * share, toxic * F.ln(toxic / (n * share)) + rare).otherwise(0.0)


def beyond_chance(rows: list[tuple[str, int, int]], tested: int, share: float) -> list[tuple[str, int, int]]:
    """The (stem, toxic, clean) of least chance, as many as keep the share of false ones, of all `tested`, in bound."""
    ranked = sorted(rows, key=lambda r: (-surprise(r[1], r[2], share), r[0]))
    fits = [k for k, (_, t, c) in enumerate(ranked, 1) if surprise(t, c, share) >= np.log(tested / (FALSE_SHARE * k))]
    return ranked[: max(fits, default=0)]


def choose_stems(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Stems by value, the sum of weight and log support, the longer of equals first; none within another's path."""
    weight = {s: float(np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))) for s, t, c in rows}
    support = {s: t for s, t, _ in rows}
    chosen: dict[str, float] = {}
    inner: set[str] = set()
    for s in sorted(support, key=lambda s: (-round(weight[s] + float(np.log(support[s])), 6), -len(s), s)):
        paths = [s[:n] for n in range(MIN_STEM, len(s) + 1)]
        if s not in inner and not any(x in chosen for x in paths):
            chosen[s] = weight[s]
            inner.update(paths)
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; all but the constant are kept small."""
    w = np.zeros(x.shape[1])
    pull = ridge * np.array([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9), x.T @ (weight * (y - p)) - pull * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 3, hidden: int = 1, doc_id: str = "doc_id", text: str = "text",
    most: int = MOST_LABELLED, min_weight: float = 3.0,
) -> Grammar:
    """The grammar; only rows whose fold is not the hidden one are learnt from."""
    sample = labelled_sample(docs, labels, label, most={1: most, 0: 2 * most}, folds=folds, hidden=hidden, doc_id=doc_id, text=text)

    @F.arrow_udf("struct<key:bigint,words:array<string>>")
    def words_of(texts: pa.Array) -> pa.Array:
        kind, parts = pa.struct([("key", pa.int64()), ("words", pa.list_(pa.string()))]), []
        for a in range(0, max(len(texts), 1), 128):  # word lists as Python objects are large
            out = []
            for t in texts.slice(a, 128).to_pylist():
                words = WORD.findall((t or "").lower())
                out.append({"key": sketch(words), "words": sorted(set(words))})
            parts.append(pa.array(out, type=kind))
        return pa.concat_arrays(parts)

    sample = settle(sample.select("text", "label", words_of(F.col("text")).alias("w")).select("text", "label", "w.*").groupBy("key", "label").agg(F.min_by(F.struct("text", "words"), F.struct(F.length("text"), F.xxhash64("text"))).alias("x")).select("label", "x.*"))
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Grammar()
    in_toxic = settle(stem_counts(sample.where("label = 1")).where(F.col("n") >= MIN_DOCUMENTS))
    sizes, share = {r.n: r.stems for r in in_toxic.groupBy("n").agg(F.count("*").alias("stems")).collect()}, n_toxic / (n_toxic + n_clean)
    tested = sum(sizes.values())
    # Even if no clean document had them, stems of fewer toxic ones would not be taken; what is left is bounded by the sample.
    enough = min((t for t in sizes if share**t * tested <= FALSE_SHARE * sum(k for n, k in sizes.items() if n >= t)), default=n_toxic + 1)
    toxic = in_toxic.where(F.col("n") >= enough)
    hashes = np.sort(toxic.select(F.xxhash64("stem").alias("h")).toArrow()["h"].to_numpy())  # 8 bytes a stem of the bounded sample
    clean = stem_counts(sample.where("label = 0"), hashes).withColumnRenamed("n", "c")
    both = toxic.join(clean, "stem", "left").select("stem", F.col("n").alias("t"), F.coalesce("c", F.lit(0)).alias("c"))
    # beyond_chance takes none below this bound, whatever its rank, so the rest stays where it is.
    possible = both.where(surprise_column(F.col("t"), F.col("c"), share) >= -np.log(FALSE_SHARE) - 1e-6).toArrow().to_pydict()
    likely = beyond_chance(list(zip(possible["stem"], possible["t"], possible["c"], strict=True)), tested, share)
    heavy = [(s, t, c) for s, t, c in likely if np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1)) >= min_weight]
    grammar = Grammar(choose_stems(heavy, n_toxic, n_clean))
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([held.value.features(t) for t in texts.to_pylist()], type=pa.list_(pa.float64()))

    shapes = sample.select("label", features(F.col("text")).alias("f")).groupBy("label", "f").agg(F.count("*").alias("n")).collect()  # at most the bounded sample
    x, y = np.array([r.f for r in shapes]), np.array([float(r.label) for r in shapes])
    grammar.weights = logistic(x, y, np.array([float(r.n) for r in shapes]))
    unmatched = Counter()
    for r in shapes:
        if not r.f[1]:
            unmatched[r.label] += r.n
    grammar.blank = (unmatched[1] + 0.01) / (sum(unmatched.values()) + 1)
    return grammar


CLAUSES = "array<struct<weight:double,words:array<string>,negated:boolean,reported:boolean,targeted:boolean>>"


def score_toxicity(docs: DataFrame, grammar: Grammar, *, text: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with `out`: the probability of label 1, in one pass and without a shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([held.value.score(t) for t in texts.to_pylist()], type=pa.float64())

    return docs.withColumn(out, of(F.col(text)))


def matched_clauses(docs: DataFrame, grammar: Grammar, *, text: str = "text", out: str = "toxic_clauses") -> DataFrame:
    """docs with `out`: the clauses that the score rests on."""
    held = docs.sparkSession.sparkContext.broadcast(grammar)
    kind = pa.list_(pa.struct([("weight", pa.float64()), ("words", pa.list_(pa.string())), ("negated", pa.bool_()), ("reported", pa.bool_()), ("targeted", pa.bool_())]))

    @F.arrow_udf(CLAUSES)
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([held.value.clauses(t) for t in texts.to_pylist()], type=kind)

    return docs.withColumn(out, of(F.col(text)))
