"""Language identification by a convolutional network over bytes.

Filters of several widths slide over windows of a fixed number of bytes; the highest response of each filter in a
window is kept (max pooling), and a softmax over these tells the languages apart.  Trained in numpy on a bounded,
documented sample of labelled rows; applied to every window of every text, in batches.  A text's scores are the mean of
its windows' scores, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, bounded_batches, sampled

UNKNOWN = "und"
WINDOW = 256
#: Windows that are convolved at once.
BLOCK = 256
#: Labelled rows that a fit reads at most, chosen by a hash of id and text; of these, whole texts.
FIT_ROWS = 1500


@dataclass
class ByteCnn:
    """Weights: for each width w an array (w, 256, filters); the softmax's (widths * filters, languages)."""

    languages: list[str]
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    kernels: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: np.ndarray | None = None

    def start(self, seed: int) -> ByteCnn:
        rng = np.random.default_rng(seed)
        self.kernels = [rng.normal(0, 0.3, (w, 256, self.filters)).astype(np.float32) for w in self.widths]
        for k in self.kernels:
            k[:, 0] = 0  # the filling after a text's end
        n = len(self.widths) * self.filters
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(self.languages))).astype(np.float32)
        self.out_bias = np.zeros(len(self.languages), np.float32)
        return self

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """(windows, positions, filters) for each width."""
        return [sum(k[j][x[:, j : x.shape[1] - w + 1 + j]] for j in range(w)) for w, k in zip(self.widths, self.kernels, strict=True)]

    def pooled(self, x: np.ndarray, tables: list) -> np.ndarray:
        """The highest response of each filter, from tables of byte pairs."""
        pairs = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        out = []
        for w, parts in zip(self.widths, tables, strict=True):
            n = x.shape[1] - w + 1
            total = None
            for j, table in parts:
                at = table[pairs[:, j : j + n]] if len(table) > 256 else table[x[:, j : j + n]]
                total = at if total is None else np.add(total, at, out=total)
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def pair_tables(self) -> list[list[tuple[int, np.ndarray]]]:
        out = []
        for w, k in zip(self.widths, self.kernels, strict=True):
            parts = [(j, (k[j][:, None] + k[j + 1][None]).reshape(65536, self.filters)) for j in range(0, w - 1, 2)]
            out.append(parts + ([(w - 1, k[w - 1])] if w % 2 else []))
        return out

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int, rate: float = 0.01, batch: int = 64) -> ByteCnn:
        """Adam on the cross entropy, each language weighted alike."""
        rng = np.random.default_rng(seed)
        weight = len(y) / (len(self.languages) * np.bincount(y, minlength=len(self.languages)).clip(1))
        params = [*self.kernels, self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                xb, yb, step = x[rows], y[rows], step + 1
                found = self.responses(xb)
                places = [r.argmax(axis=1) for r in found]
                raw = np.concatenate([np.take_along_axis(r, p[:, None], 1)[:, 0] for r, p in zip(found, places, strict=True)], axis=1) + self.bias
                hidden = np.maximum(raw, 0)
                z = hidden @ self.out + self.out_bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(yb)), yb] -= 1
                p *= (weight[yb] / len(yb))[:, None]
                back = (p @ self.out.T) * (raw > 0)
                grads = []
                for i, (w, place) in enumerate(zip(self.widths, places, strict=True)):
                    g, k = back[:, i * self.filters : (i + 1) * self.filters], np.zeros_like(self.kernels[i])
                    for j in range(w):
                        np.add.at(k[j], (np.take_along_axis(xb, place + j, 1), np.arange(self.filters)[None]), g)
                    k[:, 0] = 0
                    grads.append(k)
                grads += [back.sum(0), hidden.T @ p, p.sum(0)]
                for q, g, m, v in zip(params, grads, first, second, strict=True):
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def as_windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of some texts, filled up with zeros; the text of each; its bytes.  An empty text has one window."""
    n = np.array([max(1, -(-len(t) // size)) for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), n)
    x = np.frombuffer(b"".join(t.ljust(size * int(k), b"\0") for t, k in zip(texts, n, strict=True)), np.uint8).reshape(-1, size)
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    lengths = np.array([len(t) for t in texts], np.int64)
    return x, text, np.clip(lengths[text] - (np.arange(len(text)) - first[text]) * size, 1, size)


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> list[tuple[str, str]]:
    """(label, whole text) of at most rows labelled rows.  Only these reach the driver."""
    label, text = F.col(f"`{label_col}`"), F.col(f"`{text_col}`").cast("string")
    labelled = docs.where(label.isNotNull() & F.col(f"`{id_col}`").isNotNull() & text.rlike(r"\S"))
    chosen = sampled(labelled, id_col, text, rows, labelled.count(), 42)
    return sorted((r.label, r.text) for r in chosen.select(label.cast("string").alias("label"), text.alias("text")).limit(rows).collect())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = FIT_ROWS, epochs: int = 3, seed: int = 7) -> ByteCnn | None:
    """A network fitted on the windows of a sample of docs; None if no row has a label and a text.

    Of two in five windows only the beginning is shown, so that short texts are met as well.
    """
    got = sample(docs, id_col, text_col, label_col, rows)
    if not got:
        return None
    languages = sorted({label for label, _ in got})
    x, text, size = as_windows([t.encode() for _, t in got])
    x, rng = x.copy(), np.random.default_rng(seed)
    cut = np.where(rng.random(len(x)) < 0.4, np.maximum(rng.integers(1, WINDOW + 1, len(x)), 6), WINDOW)
    x[np.arange(WINDOW)[None] >= cut[:, None]] = 0
    labels = np.array([languages.index(label) for label, _ in got])[text]
    return ByteCnn(languages).start(seed).fit(x.astype(np.int64), labels, epochs, seed)


def predict(docs: DataFrame, model: ByteCnn | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row struct (docs' columns, or those in keep), lang_pred string, score double: row by row, whole texts, no shuffle.

    und with score 0 where the text is null or has no letter, or where nothing could be learned.  Ties of languages go
    to the first in their sorted order.  Repeated rows give repeated results; an empty table gives none; a text of any
    length is worked off in blocks of windows.  Other columns stand inside row, so that no name clashes.
    """
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    told = F.coalesce(F.col(f"`{text_col}`").cast("string").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(row, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    inside = text_col in keep and dict(docs.dtypes)[text_col] == "string"  # the text need not be sent twice
    picked = bounded_batches(docs).select(row, told.alias("told"), *([] if inside else [F.col(f"`{text_col}`").cast("string").alias("text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.pair_tables()
        languages = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            tell = batch.column(1).to_numpy(zero_copy_only=False)
            texts = [t if k else b"" for t, k in zip(binary(batch.column(0).field(text_col) if inside else batch.column(2)), tell, strict=True)]
            sums, total = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
            for numbers, x, text, size in _blocks(texts):
                z = model.scores(model.pooled(x, tables)).astype(np.float64)
                np.add.at(sums, numbers[text], z * size[:, None])
                np.add.at(total, numbers[text], size)
            z = sums / np.maximum(total, 1)[:, None]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best, none = p.argmax(1), ~tell
            score = np.where(none, 0.0, p[np.arange(len(best)), best])
            best[none] = len(model.languages)
            yield pa.RecordBatch.from_arrays([batch.column(0), languages.take(pa.array(best)), pa.array(score)], ["row", "lang_pred", "score"])

    schema = f"row {picked.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return picked.mapInArrow(run, schema)


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of the non-empty texts, BLOCK at a time and more only while texts are short."""
    numbers: list[int] = []
    parts: list[bytes] = []
    n = 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), BLOCK * WINDOW):
            piece = t[at : at + BLOCK * WINDOW]
            numbers.append(i)
            parts.append(piece)
            n += -(-len(piece) // WINDOW)
            if n >= BLOCK:
                yield np.array(numbers), *as_windows(parts)
                numbers, parts, n = [], [], 0
    if parts:
        yield np.array(numbers), *as_windows(parts)
