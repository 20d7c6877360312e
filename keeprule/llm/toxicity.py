"""Toxicity by a weighted finite-state grammar over the words of a clause.

Five transducers are tables of states and weighted arcs over kinds of words. Negation, reported speech and target hand
on what they read with a mark, as far as their scope reaches; insult and threat weigh what is marked. Composed, they are
one machine, and a clause's score is the weight of its path: the same word counts more where it is aimed at someone,
half where somebody is quoted, not at all where it is denied, and a threat counts only with a target behind it.

The lexicon of insults is learned: words, or beginnings of at least four letters, that labelled toxic documents hold far
more often than others. A logistic model over the clause scores, and nothing else, gives the probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
STEM_LETTERS = (4, 14)
#: A stem counts if so many toxic documents of the sample hold it, and this part of them.
MIN_DOCS, MIN_PART = 4, 0.01
MIN_WEIGHT, GAIN = 4.0, 1.0
#: A stem is taken for one word if that word has so large a part of its documents.
ONE_WORD = 0.8
#: How many of the words after a negation or a target they cover, and how many words a threat waits for its target.
NEGATION_SCOPE, TARGET_SCOPE, THREAT_REACH = 3, 3, 2

THREATS = frozenset("kill hurt destroy shoot stab burn töten schlagen tuer frapper matar golpear".split())
TARGETS = frozenset("you your yours he she they them him her du dich dein sie ihr tu toi ton vous il elle tú usted él ella".split())
NEGATIONS = frozenset("not never no isn aren wasn don doesn nicht kein keine nie pas jamais nunca jamás".split())
REPORTS = frozenset("said says say quoted called wrote claims sagte sagt schrieb dit disait écrit dijo dice escribió".split())
WORDS_OF = (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS))
KIND = {word: kind for kind, words in WORDS_OF for word in words}
THREAT_WEIGHT = 2.0
#: What is left of a weight in reported speech and in a negation, and what an aimed insult gains.
REPORTED, NEGATED, AIMED = 0.5, 0.0, 1.5

#: What the model sees of a document: whether any clause has a weight, the sum, and the largest.
FEATURES = ("any", "weight", "best")

KINDS = ("other", "insult", "threat", "target", "negation", "report")


class Symbol(NamedTuple):
    """A kind of word with the marks that transducers put on it."""

    kind: str
    negated: bool = False
    reported: bool = False
    aimed: bool = False


ALPHABET = [Symbol(kind, *marks) for kind in KINDS for marks in product((False, True), repeat=3)]
#: (state, symbol read) to (next state, symbol written, factor of the word's own weight, weight of the arc).
Arcs = dict[tuple[object, Symbol], tuple[object, Symbol, float, float]]


class Transducer(NamedTuple):
    start: object
    arcs: Arcs


def scope_transducer(kind: str, mark: str, words: int | None) -> Transducer:
    """Marks the ``words`` symbols after one of ``kind``, or all of them if None. States: how many are still to mark."""
    most = 1 if words is None else words
    arcs: Arcs = {}
    for left in range(most + 1):
        for read in ALPHABET:
            written = read._replace(**{mark: True}) if left else read
            after = left if words is None else max(0, left - 1)
            arcs[left, read] = (most if read.kind == kind else after, written, 0.0, 0.0)
    return Transducer(0, arcs)


def _kept(read: Symbol) -> float:
    return (NEGATED if read.negated else 1.0) * (REPORTED if read.reported else 1.0)


def insult_transducer() -> Transducer:
    """One state; an insult's arc carries the factor that its marks leave of the weight of the word."""
    weigh = lambda read: _kept(read) * (AIMED if read.aimed else 1.0) if read.kind == "insult" else 0.0
    return Transducer("any", {("any", read): ("any", read, weigh(read), 0.0) for read in ALPHABET})


def threat_transducer() -> Transducer:
    """Waits after a threat for a target; its arc to a target carries what the threat's marks leave of its weight."""
    idle = (0, 0.0)
    states = [idle, *((left, kept) for left in range(1, THREAT_REACH + 1) for kept in sorted({_kept(read) for read in ALPHABET}))]
    arcs: Arcs = {}
    for left, kept in states:
        for read in ALPHABET:
            if read.kind == "threat":
                arcs[(left, kept), read] = ((THREAT_REACH, _kept(read)), read, 0.0, 0.0)
            elif read.kind == "target":
                arcs[(left, kept), read] = (idle, read, 0.0, THREAT_WEIGHT * kept if left else 0.0)
            else:
                arcs[(left, kept), read] = ((left - 1, kept) if left > 1 else idle, read, 0.0, 0.0)
    return Transducer(idle, arcs)


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``; weights of both arcs add up."""
    start = (first.start, second.start)
    arcs, found, work = {}, {start}, [start]
    while work:
        one, two = state = work.pop()
        for read in ALPHABET:
            after_one, between, factor_one, weight_one = first.arcs[one, read]
            after_two, written, factor_two, weight_two = second.arcs[two, between]
            after = (after_one, after_two)
            arcs[state, read] = (after, written, factor_one + factor_two, weight_one + weight_two)
            if after not in found:
                found.add(after)
                work.append(after)
    return Transducer(start, arcs)


def cascade() -> list[Transducer]:
    return [
        scope_transducer("negation", "negated", NEGATION_SCOPE),
        scope_transducer("report", "reported", None),
        scope_transducer("target", "aimed", TARGET_SCOPE),
        insult_transducer(),
        threat_transducer(),
    ]


def _numbered(machine: Transducer) -> dict[str, list[tuple[int, float, float]]]:
    """For each kind of word the next state, factor and weight by state; the start is state 0."""
    states = {machine.start: 0}
    for state, _ in machine.arcs:
        states.setdefault(state, len(states))
    table = {}
    for kind in KINDS:
        rows = [machine.arcs[state, Symbol(kind)] for state in states]
        table[kind] = [(states[after], factor, weight) for after, _, factor, weight in rows]
    return table


MACHINE = _numbered(reduce(composed, cascade()))


@dataclass
class Grammar:
    """Learned weights by stem; a stem that ends with ``$`` is a whole word. ``model`` has a bias and FEATURES."""

    stems: dict[str, float] = field(default_factory=dict)
    model: np.ndarray = field(default_factory=lambda: np.array([-2.0, *[0.0] * len(FEATURES)]))

    def insult(self, word: str) -> float:
        """Weight of the longest stem of ``word``; 0 if it has none."""
        if (weight := self.stems.get(word + "$")) is not None:
            return weight
        for n in range(min(len(word), STEM_LETTERS[1]), STEM_LETTERS[0] - 1, -1):
            if (weight := self.stems.get(word[:n])) is not None:
                return weight
        return 0.0

    def finder(self) -> ahocorasick.Automaton | None:
        """Finds texts that may hold a matched phrase at all: every phrase holds a stem or a threat."""
        found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for stem in {s.rstrip("$") for s in self.stems} | THREATS:
            found.add_word(stem)
        found.make_automaton()
        return found

    def phrases(self, clause: str) -> list[tuple[str, float]]:
        """The words at which the path of a clause through the machine has a weight, with that weight."""
        state, found = 0, []
        for word in WORD.findall(clause):
            kind, own = KIND.get(word), 0.0
            if kind is None:
                own = self.insult(word)
                kind = "insult" if own else "other"
            state, factor, weight = MACHINE[kind][state]
            if factor or weight:
                found.append((word, factor * own + weight))
        return found

    def features(self, text: str) -> list[float]:
        """What the clause scores of a text in lower case add up to."""
        scores = [sum(weight for _, weight in self.phrases(clause)) for clause in CLAUSE_END.split(text)]
        total = sum(scores)
        return [float(total > 0), math.log1p(total), math.log1p(max(scores))]

    def chance(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.model[0] + features @ self.model[1:], -30, 30)))


def stems_of(text: str) -> set[str]:
    """The stems of all words of a text."""
    found = set()
    for word in set(WORD.findall(text.lower())):
        found.update(word[:n] for n in range(STEM_LETTERS[0], min(len(word), STEM_LETTERS[1]) + 1))
        found.add(word + "$")
    return found


def _stem_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for stem in stems_of(text):
                counts.setdefault(stem, [0, 0])[toxic] += 1
        clean, toxic = zip(*counts.values(), strict=True) if counts else ((), ())
        columns = [pa.array(list(counts), pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["stem", "toxic", "clean"])


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int) -> DataFrame:
    """Text and label of about ``sample_rows`` labelled learning rows of each label, chosen by a hash of the id.

    Copies of a text count once, lest one text's words look like those of many.
    """
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(learn & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    sizes = {r["toxic"]: r["count"] for r in known.where(learn).groupBy("toxic").count().collect()}  # two labels
    part = F.when(F.col("toxic") == 1, sample_rows / max(1, sizes.get(1, 0))).otherwise(sample_rows / max(1, sizes.get(0, 0)))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < part * (1 << 20))
    # About sample_rows ids of each label: without a broadcast all texts would be shuffled to find their documents.
    return rows.join(F.broadcast(drawn), "doc_id").groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def choose_stems(counts, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Shortest stems with a large weight, and longer ones where they add GAIN to it; weights are log ratios.

    A stem that stands for little more than one word gives way to the words, so that others which begin so are spared.
    """
    weights = np.log((counts["toxic"] + 0.5) / (n_toxic + 1)) - np.log((counts["clean"] + 0.5) / (n_clean + 1))
    chosen: dict[str, float] = {}
    for stem, weight in sorted(zip(counts["stem"], weights, strict=True), key=lambda x: (len(x[0]), x[0])):
        inside = max((chosen[stem[:n]] for n in range(STEM_LETTERS[0], len(stem)) if stem[:n] in chosen), default=-1e9)
        if weight >= max(MIN_WEIGHT, inside + GAIN):
            chosen[stem] = float(weight)
    docs = dict(zip(counts["stem"], counts["toxic"], strict=True))
    weight_of = dict(zip(counts["stem"], weights, strict=True))
    for stem in [s for s in chosen if not s.endswith("$")]:
        words = [w for w in docs if w.endswith("$") and w.startswith(stem) and weight_of[w] >= MIN_WEIGHT]
        if max((docs[w] for w in words), default=0) >= ONE_WORD * docs[stem]:
            del chosen[stem]
            chosen.update({w: float(weight_of[w]) for w in words})
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Bias and coefficients of a logistic model, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x / weights.sum() + penalty
        step = np.linalg.solve(hessian, x.T @ (weights * (y - p)) / weights.sum() - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = 6000) -> Grammar:
    """A grammar from about ``sample_rows`` learning rows of each label; without labels of both kinds, seeds alone."""
    sample = labelled_sample(docs, labels, learn, sample_rows).persist()
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two labels
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    grammar = Grammar()
    if n_toxic and n_clean:
        counts = sample.mapInArrow(_stem_batches, "stem string, toxic long, clean long")
        totals = counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        lift = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
        telling = totals.where((F.col("toxic") >= max(MIN_DOCS, MIN_PART * n_toxic)) & (lift >= MIN_WEIGHT)).toPandas()  # bounded by the sample
        grammar.stems = choose_stems(telling, n_toxic, n_clean)

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [grammar.features(t.lower()) for t in batch.column("text").to_pylist()]
                values = pa.array(rows, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([values, batch.column("toxic")], ["x", "toxic"])

        rows = sample.mapInArrow(measured, "x array<double>, toxic int").toPandas()  # sample_rows of each label
        y = rows["toxic"].to_numpy(float)
        share = labels.where(learn).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
        weights = np.where(y == 1, share / max(1, n_toxic), (1 - share) / max(1, n_clean))
        grammar.model = fit_logistic(np.array(rows["x"].tolist()), y, weights)
    sample.unpersist()
    return grammar


def score(docs: DataFrame, grammar: Grammar, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``threshold`` on) of every row of ``docs``.

    Null and empty texts have no matched phrase and get the score of such texts. Repeated rows are scored each for
    itself; other columns are left out.
    """
    none = float(grammar.chance(np.zeros((1, len(FEATURES))))[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = grammar.finder()
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                lower = (text.as_py() or "").lower()
                if next(finder.iter(lower), None) is None:
                    scores.append(none)
                else:
                    scores.append(float(grammar.chance(np.array([grammar.features(lower)]))[0]))
            scores = np.array(scores)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), predicted], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int")
