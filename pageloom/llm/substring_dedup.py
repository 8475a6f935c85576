"""Removal of passages that stand earlier, in another document or the same.

Every window of n consecutive words has a Rabin-Karp hash of 80 bits, and all of them are counted in Spark.  A task
hashes the windows of a chunk of texts.  Of windows that agree inside the chunk only the first goes on, which
bounds how often a hot passage is sent: once a chunk.  The hashes are dealt to buckets by their value, packed with their
places, one shuffle for all; the number of buckets grows with the text, so that a bucket fits a task.  There each hash
is counted, and all its windows but the first are repeated.  Repeated windows merge into maximal spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEEP, U64, WORD_BASE, Words, binary, bounded_batches, forget, in_chunks, int64, list_array, mix, order_key, saved, spans_hash

WINDOW = 20
#: Text whose windows are counted before they are sent, and text whose windows make a bucket, about.
CHUNK, BUCKET = 2 << 20, 8 << 20
_PACKED = ("docs", "versions", "sizes", "starts", "hashes", "more")
_TYPES = (np.int64, np.int32, np.uint32, np.uint32, np.uint64, np.uint16)


def window_hashes(words: Words, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits of each window, of different polynomials over different values of the words."""
    return words.window_hashes(starts, n), spans_hash(mix(words.hashes ^ U64(0x2545F4914F6CDD1D)), starts, starts + n, WORD_BASE + 2)


def not_first(first: np.ndarray, second: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of windows with these hashes and places: which have the hashes of one at an earlier place."""
    out = np.zeros(len(first), bool)
    ordered = np.sort(first)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    at = np.searchsorted(twice, first)
    at[at == len(twice)] = 0
    some = np.flatnonzero(twice[at] == first)
    some = some[np.lexsort((start[some], doc[some], second[some], first[some]))]
    h, x, d, s = first[some], second[some], doc[some], start[some]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (x[1:] != x[:-1])))
    lead = np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))
    out[some] = (d != d[lead]) | (s != s[lead])
    return out


def _planes(values: np.ndarray) -> bytes:
    """The values' first bytes, their second ones and so on, which Spark's compression of shuffles likes better."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _pack(doc: np.ndarray, version: np.ndarray, start: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[bytes]:
    """Windows, those of one text together and in order."""
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))))
    sizes = np.diff(np.concatenate((new, [len(doc)])))
    steps = np.diff(start.astype(np.uint32), prepend=np.uint32(0))  # modulo 2**32 where a text begins
    return [_planes(x.astype(t)) for x, t in zip((doc[new], version[new], sizes, steps, first, second >> U64(48)), _TYPES, strict=True)]


def _unpack(columns: list[bytes]) -> tuple[np.ndarray, ...]:
    doc, version, sizes, steps, first, second = (_from_planes(x, t) for x, t in zip(columns, _TYPES, strict=True))
    return np.repeat(doc, sizes), np.repeat(version, sizes), np.cumsum(steps, dtype=np.uint32).astype(np.int64), first, second


def _chunk(raw: list[bytes], doc: np.ndarray, version: np.ndarray, n: int, buckets: int) -> Iterator[tuple[int, list[bytes]]]:
    """The windows of some texts as (bucket, packed); those known to be repeated have no hashes any more."""
    order = np.lexsort((version, doc))
    new = np.concatenate(([True], (np.diff(doc[order]) != 0) | (np.diff(version[order]) != 0)))
    one = order[new]  # repeated rows are one text
    words = Words([raw[i] for i in one], KEEP)
    starts = words.windows(n)
    if not len(starts):
        return
    first, second = window_hashes(words, starts, n)
    text = words.text[starts]
    d, v, place = doc[one][text], version[one][text], starts - words.bounds[text]
    again = not_first(first, second, d, place)
    bucket = ((second & U64(0xFFFFFFFF)) % U64(buckets)).astype(np.int64)
    bucket[again] = d[again] % buckets
    key = bucket * 2 + again
    by = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.concatenate((np.diff(key[by]) != 0, [True]))) + 1
    for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
        at = by[a:b]
        done = bool(again[at[0]])
        packed = _pack(d[at], v[at], place[at], first[at], second[at])
        yield int(bucket[at[0]]), [*packed[:4], b"", b""] if done else packed


def _rows(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """row struct, text, doc, version: version tells texts of one id apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return bounded_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"), order_key(F.col(f"`{id_col}`")).alias("doc"), F.hash(text).alias("version"))


def _windows(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """All windows of all texts, packed: a row for each bucket of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, doc, version = binary(batch.column(1)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for a, b in in_chunks(raw, CHUNK):
                for bucket, packed in _chunk(raw[a:b], doc[a:b], version[a:b], n, buckets):
                    yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]], ["bucket", *_PACKED])

    return texts.select("doc", "text", "version").mapInArrow(run, "bucket int, " + ", ".join(f"{c} binary" for c in _PACKED))


def _count(windows: DataFrame, buckets: int) -> DataFrame:
    """doc, version, start: the first word of each repeated window, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        done: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for row in batch.to_pylist():
                columns = [row[c] for c in _PACKED]
                if columns[4]:
                    parts.append(_unpack(columns))
                else:
                    doc, version, sizes, steps = (_from_planes(x, t) for x, t in zip(columns[:4], _TYPES, strict=False))
                    done.append((np.repeat(doc, sizes), np.repeat(version, sizes), np.cumsum(steps, dtype=np.uint32).astype(np.int64)))
        if parts:
            doc, version, start, first, second = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            again = not_first(first, second, doc, start)
            done.append((doc[again], version[again], start[again]))
        if not done:
            return
        doc, version, start = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.lexsort((start, version, doc))
        doc, version, start = doc[order], version[order], start[order].astype(np.int32)
        new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(version) != 0) | (np.diff(start) != 0)))[: len(doc)]
        doc, version, start = doc[new], version[new], start[new]  # what several chunks found is one
        for at in range(0, len(doc), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([int64(doc[part]), pa.array(version[part], pa.int32()), pa.array(start[part], pa.int32())], ["doc", "version", "start"])

    return windows.repartitionById(buckets, F.col("bucket")).mapInArrow(run, "doc long, version int, start int")


def repeated_windows(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc, version, starts array<int>: where windows of each text (doc, text, version) start that stand earlier."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    found = saved(_count(_windows(rows, n, buckets), buckets))
    out = saved(found.groupBy("doc", "version").agg(F.collect_list("start").alias("starts")))
    forget(found)
    return out


def _spans(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal spans that windows cover."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.unique(starts).astype(np.int64)
    new = np.concatenate(([True], np.diff(s) > n))
    return s[new], s[np.concatenate((new[1:], [True]))] + n


def _cut(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, removed, ends = [], [], [], [0]
            starts, stops = [], []
            lists = batch.column(2)
            every, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            for text, a, b in zip(binary(batch.column(1)), bounds[:-1], bounds[1:], strict=True):
                found = every[a:b]
                words = text.split()
                n_words.append(len(words))
                s, e = _spans(found, n)
                removed.append(int((e - s).sum()))
                edges = zip([0, *e.tolist()], [*s.tolist(), len(words)], strict=True)
                kept.append(b" ".join([w for a, b in edges for w in words[a:b]]))
                starts += s.tolist()
                stops += e.tolist()
                ends.append(len(starts))
            merged = list_array(ends, pa.StructArray.from_arrays([int64(starts), int64(stops)], ["start", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), int64(n_words), int64(removed), merged, pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "removed", "kept"])

    return texts.mapInArrow(run, f"row {texts.schema['row'].dataType.simpleString()}, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string")


def substring_dedup(docs: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row struct (docs' columns, or those in keep), n_words, n_removed, removed, kept: for each row of docs.

    removed: maximal spans of word numbers, in order, covered by windows of n words whose words also stand earlier
    (smaller id, or the same id and an earlier start); all windows are judged on the input.  kept: the other words,
    joined by one space.

    A null text has no words, as an empty one.  A null id comes before all others; ids are integers.  Rows that repeat an
    id and a text are judged alike, and none is earlier than the other; different texts of one id are one document by
    their places.  An empty table gives none.  A text of any length is one row of a task.  Other columns stand inside
    row, so that no name clashes.
    """
    keep = docs.columns if keep is None else keep
    rows = _rows(docs, id_col, text_col, keep)
    found = repeated_windows(rows, n)
    return _cut(rows.join(found, ["doc", "version"], "left").select("row", "text", F.coalesce("starts", F.array().cast("array<int>")).alias("starts")), n)
