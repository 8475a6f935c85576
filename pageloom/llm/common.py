"""Pieces that several operators of this subpackage share: shared storage, word hashing, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.state import CLEANUP, PRIVATE, forget, saved, shared_dir  # noqa: F401  operators take them from here

U64 = np.uint64
#: Odd multipliers, so that each has an inverse modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Bytes of text that are hashed at once; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 19


# --- columns --------------------------------------------------------------------------------------------------------


def order_key(column: Column) -> Column:
    """An integer id that is never null: null ids come before all others."""
    return F.coalesce(column.cast("long"), F.lit(-(2**63)))


def sampled(df: DataFrame, id_col: str, text: Column, rows: int, total: int, seed: int) -> DataFrame:
    """The rows of df, of total, with the least hashes of id and text: so many, and more only where rows repeat.  Their
    keys are sorted, not the rows; no text passes through one task."""
    share = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)), F.lit(1 << 30))
    key = F.struct(share.alias("h"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("k"))
    some = df.where(share < min(1.0, 1.2 * rows / max(1, total) + 50 / max(1, total)) * (1 << 30))
    last = some.select(key.alias("key")).orderBy("key").limit(rows).agg(F.max("key").alias("m")).first().m
    if last is None:
        return df.where(F.lit(False))
    return some.where(key <= F.struct(F.lit(last.h).cast("long").alias("h"), F.lit(last.k).cast("long").alias("k")))


# --- hashing of words -----------------------------------------------------------------------------------------------

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Maps bytes to the lower-case byte; 0 for what separates words.
_bytes = np.arange(256, dtype=np.uint8)
FOLD_ALNUM = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)
FOLD_ALNUM[~(((FOLD_ALNUM >= 0x30) & (FOLD_ALNUM <= 0x39)) | ((FOLD_ALNUM >= 0x61) & (FOLD_ALNUM <= 0x7A)) | (FOLD_ALNUM >= 0x80))] = 0
#: As it is; 0 for white space.  Bytes 0 are mapped to 1, which no hash below mistakes for a separator.
KEEP = np.where(SPACES, 0, np.maximum(_bytes, 1)).astype(np.uint8)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, n of them at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        _powers[base] = have
    return have


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences over all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp: the polynomial of values[start:end] at base, from running sums, whatever its place; mixed."""
    n = len(values)
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum(values * powers(base, n + 1)[:n], dtype=U64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(inverse(base), n + 1)[starts])


def _hash_piece(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = folded != 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    return starts, ends, spans_hash(folded.astype(U64), starts, ends, BYTE_BASE)


def hash_words(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets where words start and end, and their hashes.  table maps bytes to folded bytes, 0 for separators.

    Works in pieces cut at separators, so that memory is bounded by the piece and not by the text.
    """
    folded = table[np.frombuffer(data, np.uint8)]
    if len(folded) <= CHUNK_BYTES:
        return _hash_piece(folded)
    out, at = [], 0
    while at < len(folded):
        to = min(at + CHUNK_BYTES, len(folded))
        while to < len(folded):
            gaps = np.flatnonzero(folded[at:to] == 0)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            to = min(to + CHUNK_BYTES, len(folded))  # one word of megabytes
        s, e, h = _hash_piece(folded[at:to])
        out.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Words:
    """The words of some texts together: hash and text number of each, and the bounds of each text's words."""

    def __init__(self, texts: list[bytes], table: np.ndarray):
        lengths = np.array([len(t) for t in texts], np.int64)
        begins = np.concatenate(([0], np.cumsum(lengths + 1)))  # a separator follows each text
        self.starts, self.ends, self.hashes = hash_words(b"\n".join(texts), table)
        self.bounds = np.searchsorted(self.starts, begins)
        self.text_begins = begins
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, n: int) -> np.ndarray:
        """First words of the runs of n words that lie in one text."""
        if len(self.hashes) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[: len(self.text) - n + 1] == self.text[n - 1 :])

    def window_hashes(self, starts: np.ndarray, n) -> np.ndarray:
        return spans_hash(self.hashes, starts, starts + n, WORD_BASE)


def in_chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


# --- Arrow ----------------------------------------------------------------------------------------------------------


#: Rows and bytes that Spark hands to a Python worker at once, at most: texts are long, and workers have little memory.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, once the session's limits of Arrow batches are no higher than BATCH_ROWS and BATCH_BYTES."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def binary(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def int64(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64), pa.int64())


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32), pa.int32()), values)
