"""Quality from weak labels: heuristic labellers vote, EM finds how far each can be trusted, a linear scorer learns.

Labellers look at a few measurements and vote good, bad or not at all. All documents are counted by their votes (at
most 3 to the number of labellers patterns); expectation-maximisation over the patterns estimates the share of good
documents and each labeller's accuracy on good and on bad ones. The posterior of its pattern is a document's weak label.
A linear model over hashed words and hashed measurement levels is fitted to the posteriors of a bounded sample and scores
every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.llm.common import pieces, text_bytes
from keeprule.llm.shingles import word_hashes

AT_ONCE = 2_000_000
NEVER = -1.0
#: Labeller: measurement, bad from this value on, good up to this value. Lack of one defect is no reason to call a text
#: good; only the two that look at the whole text do.
LABELLERS = (
    ("capitals", 0.5, NEVER),
    ("symbols", 0.1, NEVER),
    ("exclamations", 0.2, NEVER),
    ("repeats", 0.2, NEVER),
    ("digits", 0.3, NEVER),
    ("shortness", 0.2, NEVER),
    ("odd characters", 0.06, 0.03),
    ("worst part", 0.1, 0.06),
)
BUCKETS, LEVELS = 4096, 10
SIZE = BUCKETS + LEVELS * len(LABELLERS)


def measurements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of measurements for each text, the hashes of all words in order, and each text's number of words."""
    data, offsets = text_bytes(texts)
    hashes, words = word_hashes(texts)
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    capitals = sums(upper) / np.maximum(1, sums(upper) + sums(lower))
    symbols = sums(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))) / np.maximum(1, words)
    shouts = sums(data == 33) / np.maximum(1, words)
    digits = sums((data >= 48) & (data <= 57)) / np.maximum(1, np.diff(offsets))
    same = np.zeros(len(hashes) + 1)
    same[1:-1] = hashes[1:] == hashes[:-1]
    ends = np.cumsum(words)
    starts = ends - words
    total = np.concatenate([[0], np.cumsum(same)])
    repeats = (total[ends] - total[np.minimum(starts + 1, ends)]) / np.maximum(1, words)
    usual = upper | lower | (data >= 128) | np.isin(data, np.frombuffer(b" \n.,", np.uint8))
    odd = 1 - sums(usual) / np.maximum(1, np.diff(offsets))
    worst = np.maximum(np.maximum(symbols, repeats), np.maximum(capitals, digits))
    found = [capitals, symbols, shouts, repeats, digits, 1 / np.maximum(1, words), odd, worst]
    return np.stack(found, 1), hashes, words


def votes(measured: np.ndarray) -> np.ndarray:
    """1 for good, -1 for bad, 0 for no vote, by text and labeller."""
    bad, good = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
    return np.where(measured >= bad, -1, np.where(measured <= good, 1, 0))


def pattern_of(cast: np.ndarray) -> np.ndarray:
    return (cast + 1) @ 3 ** np.arange(len(LABELLERS))


def _votes_of(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


@dataclass
class LabelModel:
    """Share of good texts, and how often each labeller is right when it votes."""

    share: float
    accuracy: np.ndarray

    @classmethod
    def fit(cls, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
        """EM from the start that each labeller is right four times of five; votes not cast say nothing."""
        cast = _votes_of(patterns)
        model = cls(0.8, np.full(len(LABELLERS), 0.8))
        for _ in range(rounds):
            good = model.posterior(patterns)
            right = np.where(cast > 0, good[:, None], np.where(cast < 0, 1 - good[:, None], 0)) * counts[:, None]
            accuracy = (right.sum(0) + 4) / (((cast != 0) * counts[:, None]).sum(0) + 5)
            model = cls((float(good @ counts) + 4) / (counts.sum() + 5), np.clip(accuracy, 0.55, 0.99))
        return model

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        odds = np.log(self.share / (1 - self.share)) + _votes_of(patterns) @ np.log(self.accuracy / (1 - self.accuracy))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _pattern_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", AT_ONCE):
            found, n = np.unique(pattern_of(votes(measurements(part.column("text"))[0])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pattern", "n"])


def _levels(measured: np.ndarray) -> np.ndarray:
    """Feature number of each measurement's level."""
    level = np.minimum((np.sqrt(np.clip(measured, 0, 1)) * LEVELS).astype(int), LEVELS - 1)
    return BUCKETS + np.arange(len(LABELLERS)) * LEVELS + level


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", AT_ONCE):
            measured, hashes, words = measurements(part.column("text"))
            rows = []
            for start, n in zip(np.cumsum(words) - words, words, strict=True):
                x = np.bincount(_buckets(hashes[start : start + n]), minlength=BUCKETS) / max(1, n)
                rows.append(x.astype(np.float32).tobytes())
            pattern = pa.array(pattern_of(votes(measured)))
            levels = pa.array(list(_levels(measured)), pa.list_(pa.int64()))
            columns = [pattern, levels, pa.array(rows, pa.binary()), part.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["pattern", "levels", "words", "n"])


def fit(docs: DataFrame, sample_rows: int = 4000, rounds: int = 300) -> tuple[LabelModel, np.ndarray]:
    """The label model over all documents, and bias and weights of the scorer from about ``sample_rows`` of them."""
    rows = docs.select("doc_id", "text")
    counted = rows.select("text").mapInArrow(_pattern_batches, "pattern long, n long")
    patterns = counted.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()  # 3 ** labellers at most
    model = LabelModel.fit(patterns["pattern"].to_numpy(), patterns["n"].to_numpy(float))
    total = int(patterns["n"].sum())
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    draw = place < sample_rows / max(1, total) * (1 << 30)
    # Rows that repeat are drawn together: they travel as one with their number, and 2 * sample_rows is a firm bound.
    drawn = rows.where(draw).groupBy("doc_id", "text").agg(F.count("*").alias("n")).orderBy(place, "doc_id", "text").limit(2 * sample_rows)
    sample = drawn.select("text", "n").mapInArrow(_sample_batches, "pattern long, levels array<long>, words binary, n long").toPandas()
    weights = np.zeros(SIZE + 1)
    if len(sample):
        x = np.zeros((len(sample), SIZE + 1), np.float32)
        x[:, 1 : BUCKETS + 1] = np.stack([np.frombuffer(w, np.float32) for w in sample["words"]])
        x[np.arange(len(sample))[:, None], np.stack(sample["levels"]) + 1] = 1
        x[:, 0] = 1
        y = model.posterior(sample["pattern"].to_numpy())
        share = sample["n"].to_numpy(float) / sample["n"].sum()
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            weights -= 1.0 * (x.T @ (share * (p - y)) + 1e-4 * weights)
    return model, weights


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) and kept (score of at least ``threshold``) of every row of ``docs``.

    A null text is scored as an empty one. Repeated rows are scored each for itself; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for part in pieces(batch, "text", AT_ONCE):
                measured, hashes, words = measurements(part.column("text"))
                sums = np.concatenate([[0], np.cumsum(w[1 + _buckets(hashes)])])
                ends = np.cumsum(words)
                linear = w[0] + (sums[ends] - sums[ends - words]) / np.maximum(1, words) + w[1 + _levels(measured)].sum(1)
                chance = 1 / (1 + np.exp(-np.clip(linear, -30, 30)))
                columns = [part.column("doc_id"), pa.array(chance), pa.array(chance >= threshold)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, kept boolean")
