"""Text quality without hand labels.

Heuristic labellers vote on each text: good, bad, or nothing.  They overlap and err; expectation-maximisation estimates
how often each votes what for good and for bad texts, and with that the probability that a text is good given all its
votes.  Votes have few distinct patterns, which Spark counts over all texts, so the estimate covers every text though
the driver sees only the table of patterns.

The posterior probabilities of a bounded sample of texts (FIT_ROWS, by a hash of the id) are the labels of a linear
scorer over hashed features: each word, and each word's shape (kinds of its first and last bytes, its length, whether it
repeats the word before).  The scorer then judges all texts, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEEP, Words, binary, bounded_batches, in_chunks, int64, mix, sampled

GOOD, NOTHING, BAD = 1, 0, -1
#: Texts that the scorer is fitted on at most.
FIT_ROWS = 4000
BITS = 16
#: What is known beforehand of false alarms, as a Beta distribution: labellers look for different faults and call few good
#: texts bad.  FALSE_ALARMS is its mean, PRIOR its weight as a part of all texts.  The estimate follows the votes from
#: there; without it a fault that one labeller alone sees would end as a trait of good texts.
FALSE_ALARMS, PRIOR = 0.001, 50.0
#: Words of no weight that are counted with a text's own, so that a few words decide little.
SMOOTH = 4

_b = np.arange(256)
_UPPER, _LOWER, _DIGIT = (_b >= 65) & (_b <= 90), (_b >= 97) & (_b <= 122), (_b >= 48) & (_b <= 57)
_LETTER = _UPPER | _LOWER | (_b >= 128)
_SYMBOL = (_b > 32) & (_b < 127) & ~_UPPER & ~_LOWER & ~_DIGIT
_STOP = np.isin(_b, [ord(c) for c in ".!?;:"])
#: Kinds of bytes: letters and digits by kind, symbols each their own.
_KIND = np.where(_UPPER, 1, np.where(_LOWER, 2, np.where(_DIGIT, 3, np.where(_b >= 128, 2, np.where(_SYMBOL, _b + 8, 0))))).astype(np.int64)


def _level(value: np.ndarray, good: tuple[float, float], bad: tuple[float, float], known: np.ndarray) -> np.ndarray:
    """GOOD within good, BAD outside bad, nothing between or where it is not known."""
    vote = np.where((value >= good[0]) & (value <= good[1]), GOOD, np.where((value < bad[0]) | (value > bad[1]), BAD, NOTHING))
    return np.where(known, vote, NOTHING)


#: Name of each labeller; its votes are columns of votes().
LABELLERS = ("symbols", "capitals", "repeats", "bare_symbols", "variety", "sentences", "word_length", "marks")


class Texts:
    """Some texts with what labellers and features need."""

    def __init__(self, texts: list[bytes]):
        self.words = Words(texts, KEEP)
        self.raw = np.frombuffer(b"\n".join(texts), np.uint8)
        self.n, self.count = len(texts), self.words.counts
        w = self.words
        self.length = w.ends - w.starts
        self.again = np.zeros(len(w.hashes), bool)
        if len(w.hashes):
            self.again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.text[1:] == w.text[:-1])

    def of_bytes(self, kind: np.ndarray) -> np.ndarray:
        """How many bytes of each text are of a kind."""
        sums = np.concatenate(([0], np.cumsum(kind[self.raw])))
        begins = np.minimum(self.words.text_begins, len(self.raw))
        return sums[begins[1:]] - sums[begins[:-1]]

    def of_words(self, mask: np.ndarray) -> np.ndarray:
        return np.bincount(self.words.text[mask], minlength=self.n)

    def votes(self) -> np.ndarray:
        w, n = self.words, np.maximum(self.count, 1)
        some, many = self.count >= 3, self.count >= 30
        letters, upper = self.of_bytes(_LETTER), self.of_bytes(_UPPER)
        symbols = self.of_bytes(_SYMBOL)
        solid = np.bincount(w.text, weights=self.length, minlength=self.n)
        last, first = self.raw[w.ends - 1], self.raw[w.starts]
        before = self.raw[np.maximum(w.ends - 2, w.starts)]
        bare = (self.length <= 3) & _SYMBOL[first] & _SYMBOL[last]
        marks = (self.length >= 3) & _SYMBOL[last] & (before == last)
        order = np.lexsort((w.hashes, w.text))
        h, t = w.hashes[order], w.text[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1]))) if len(h) else np.zeros(0, bool)
        distinct = np.bincount(t[new], minlength=self.n)
        return np.stack([
            _level(symbols / np.maximum(solid, 1), (0, 0.08), (0, 0.16), some),
            _level(upper / np.maximum(letters, 1), (0, 0.2), (0, 0.5), some),
            _level(self.of_words(self.again) / n, (0, 0.05), (0, 0.2), some),
            _level(self.of_words(bare) / n, (0, 0.05), (0, 0.15), some),
            _level(distinct / np.sqrt(n), (3.0, np.inf), (1.5, np.inf), many),
            _level(self.of_words(_STOP[last] & ~marks) / n, (0.02, 0.4), (0.004, 0.6), many),
            _level(np.bincount(w.text, weights=self.length, minlength=self.n) / n, (3, 9), (2, 14), some),
            _level(self.of_words(marks) / n, (0, 0.05), (0, 0.3), some),
        ], axis=1).astype(np.int8)

    def features(self) -> np.ndarray:
        """(words, 2): numbers of hashed features."""
        w = self.words
        last = self.raw[w.ends - 1]
        before = self.raw[np.maximum(w.ends - 2, w.starts)]
        shape = ((_KIND[self.raw[w.starts]] * 256 + _KIND[last]) * 256 + _KIND[before]) * 32 + np.minimum(self.length, 15) * 2 + self.again
        half = np.uint64((1 << (BITS - 1)) - 1)
        return np.stack([(w.hashes & half).astype(np.int64), (mix(shape.astype(np.uint64) + np.uint64(1)) & half).astype(np.int64) + (1 << (BITS - 1))], axis=1)


def pattern_of(votes: np.ndarray) -> np.ndarray:
    """One number for a row of votes."""
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def votes_of(patterns: np.ndarray, n: int) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(n)[None] % 3 - 1).astype(np.int64)


@dataclass
class LabelModel:
    """prior of good; chance[c, j, v + 1] that labeller j, if it votes, votes v for a text of class c (1 good, 0 bad).

    That a labeller does not vote says nothing: its chance is 1 for either.
    """

    prior: float
    chance: np.ndarray

    @classmethod
    def fit(cls, patterns: np.ndarray, counts: np.ndarray, n: int, rounds: int = 200, tolerance: float = 1e-7, false_alarms: float = FALSE_ALARMS, prior: float = PRIOR) -> LabelModel:
        votes = votes_of(patterns, n)
        good = np.where((votes == BAD).any(1), 0.1, 0.95)  # to begin with: labellers see different faults, so that one is enough
        model = cls(0.5, np.ones((2, n, 3)))
        for _ in range(rounds):
            for c, share in enumerate((1 - good, good)):
                weight = share * counts
                known = (prior * counts.sum() + 2) * np.array([false_alarms, 1 - false_alarms]) if c else (1, 1)
                for v, extra in zip((BAD, GOOD), known, strict=True):
                    model.chance[c, :, v + 1] = (weight[:, None] * (votes == v)).sum(0) + extra
                model.chance[c, :, 1] = 0
                model.chance[c] /= model.chance[c].sum(1, keepdims=True)
                model.chance[c, :, 1] = 1
            model.prior = float(((good * counts).sum() + 1) / (counts.sum() + 2))
            old, good = good, model.posterior(votes)
            if np.abs(good - old).max(initial=0) < tolerance:
                break
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = np.arange(votes.shape[1])[None]
        odds = np.log(self.prior / (1 - self.prior)) + (np.log(self.chance[1, at, votes + 1]) - np.log(self.chance[0, at, votes + 1])).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> dict[str, float]:
        """Of each labeller: how often its votes are right, where it votes."""
        right = self.prior * self.chance[1, :, 2] + (1 - self.prior) * self.chance[0, :, 0]
        cast = right + self.prior * self.chance[1, :, 0] + (1 - self.prior) * self.chance[0, :, 2]
        return dict(zip(LABELLERS, (right / cast).tolist(), strict=False))


def fit_scorer(rows: np.ndarray, features: np.ndarray, values: np.ndarray, labels: np.ndarray, epochs: int = 60, rate: float = 0.3, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels."""
    w, b = np.zeros(1 << BITS), 0.0
    g2, gb2 = np.full(1 << BITS, 1e-8), 1e-8
    n = max(1, len(labels))
    for _ in range(epochs):
        z = np.bincount(rows, weights=w[features] * values, minlength=n)[:n] + b
        error = (1 / (1 + np.exp(-z)) - labels) if len(labels) else np.zeros(n)
        g = np.bincount(features, weights=error[rows] * values, minlength=1 << BITS) / n + decay * w
        gb = error.mean()
        g2 += g * g
        gb2 += gb * gb
        w -= rate * g / np.sqrt(g2)
        b -= rate * gb / np.sqrt(gb2)
    return w, float(b)


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def _patterns(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary(batch.column(0))
            for a, b in in_chunks(raw):
                found, counts = np.unique(pattern_of(Texts(raw[a:b]).votes()), return_counts=True)
                yield pa.RecordBatch.from_arrays([int64(found), int64(counts)], ["pattern", "n"])

    return texts.mapInArrow(run, "pattern long, n long")


def _training(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in binary(batch.column(0)):
                t = Texts([text])
                f, n = np.unique(t.features().reshape(-1), return_counts=True)
                yield pa.RecordBatch.from_arrays([int64(pattern_of(t.votes())), pa.array([f.astype(np.uint16).tobytes()], pa.binary()), pa.array([(n / (t.count[0] + SMOOTH)).astype(np.float32).tobytes()], pa.binary())], ["pattern", "features", "shares"])

    return texts.mapInArrow(run, "pattern long, features binary, shares binary")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> QualityModel:
    """The label model over all texts, and the scorer fitted on a sample of at most rows texts with words."""
    text = F.col(f"`{text_col}`").cast("string")
    counted = _patterns(bounded_batches(docs).where(text.rlike(r"\S")).select(text.alias("text"))).groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    m = len(LABELLERS)
    labels = LabelModel.fit(np.array([r.pattern for r in counted], np.int64), np.array([r.n for r in counted], np.int64), m)
    total = max(1, sum(r.n for r in counted))
    chosen = sampled(docs.where(text.rlike(r"\S")), id_col, text, rows, total, 3).select(text.alias("text"))
    got = sorted(_training(chosen).limit(rows).collect())
    features = [np.frombuffer(r.features, np.uint16).astype(np.int64) for r in got]
    values = [np.frombuffer(r.shares, np.float32).astype(np.float64) for r in got]
    where = np.repeat(np.arange(len(got)), [len(f) for f in features]) if got else np.zeros(0, np.int64)
    flat = (np.concatenate(features), np.concatenate(values)) if got else (np.zeros(0, np.int64), np.zeros(0))
    target = labels.posterior(votes_of(np.array([r.pattern for r in got], np.int64), m)) if got else np.zeros(0)
    return QualityModel(labels, *fit_scorer(where, *flat, target))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row struct, n_words, votes array<int>, posterior, score: row by row, whole texts, without a shuffle.

    posterior: of good, by the votes alone; score: the scorer's.  Null, empty and blank texts have no words: no votes,
    posterior and score 0.
    """
    keep = docs.columns if keep is None else keep
    picked = bounded_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary(batch.column(1))
            for a, b in in_chunks(raw):
                t = Texts(raw[a:b])
                votes = t.votes()
                z = np.bincount(t.words.text, weights=model.weights[t.features()].sum(1), minlength=t.n) / (t.count + SMOOTH) + model.bias
                some = t.count > 0
                p = np.where(some, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)
                posterior = np.where(some, model.labels.posterior(votes.astype(np.int64)), 0.0)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(votes.reshape(-1).astype(np.int32)), len(LABELLERS)).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), int64(t.count), listed, pa.array(posterior), pa.array(p)], ["row", "n_words", "votes", "posterior", "score"])

    return picked.mapInArrow(run, f"row {picked.schema['row'].dataType.simpleString()}, n_words long, votes array<int>, posterior double, score double")
