"""Benchmark decontamination with a positional inverted index that is distributed by documents.

A shard of the index covers about a megabyte of documents: for each of their terms the sorted places (word numbers over
the shard) where it stands.  A phrase is looked up from its rarest term in the shard: that list, less the term's offset
in the phrase, is intersected with the next rarest's list, less its offset, and so on until none is left or all terms
agree.  What is left are exactly the places where the phrase stands, as every term has been intersected.  A proximity
query intersects the same lists with a tolerance.  A document lies in one shard, so nothing is shuffled.

build_index() gives the postings as a table, which is stored and searched.  The benchmark goes to every task in blocks of
at most BLOCK_BYTES of text, of which the driver holds one at a time; what each block finds is written, a row for each
shard with hits, and the hits of all blocks are merged for each document in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD_ALNUM, Words, binary, bounded_batches, forget, in_chunks, int64, list_array, saved

WINDOW = 13
#: Benchmark text that is sent to the tasks at once.
BLOCK_BYTES = 8 << 20
#: Document text that one shard of the index covers.
SHARD_BYTES = 1 << 20


class Phrases:
    """The distinct windows of a block of items, and the items that each stands in."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        words = Words([text for _, text in items], FOLD_ALNUM)
        self.terms, ranks = np.unique(words.hashes, return_inverse=True)
        self.items = [name for name, _ in items]
        found: dict[bytes, list[int]] = {}
        for k, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
            row = ranks[a:b].astype(np.int64)
            for i in range(max(1, len(row) - n + 1) if len(row) else 0):
                found.setdefault(row[i : i + n].tobytes(), []).append(k)
        self.phrases = [np.frombuffer(p, np.int64) for p in found]
        self.owners = [np.unique(k) for k in found.values()]
        self.begins = np.concatenate(([0], np.cumsum([len(p) for p in self.phrases])))[:-1].astype(np.int64)
        self.flat = np.concatenate(self.phrases) if self.phrases else np.zeros(0, np.int64)


class Index:
    """Postings of all terms in one shard."""

    COLUMNS = ("counts", "terms", "starts", "places")

    def __init__(self, counts: np.ndarray, terms: np.ndarray, starts: np.ndarray, places: np.ndarray):
        self.counts, self.terms, self.starts, self.places = counts, terms, starts, places
        self.size, self.bounds = len(places), np.concatenate(([0], np.cumsum(counts)))
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.ends = np.append(starts, starts[-1])  # as if one more term stood nowhere

    @classmethod
    def build(cls, texts: list[bytes]) -> Index:
        words = Words(texts, FOLD_ALNUM)
        places = np.argsort(words.hashes, kind="stable").astype(np.int32)
        ordered = words.hashes[places]
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        return cls(words.counts.astype(np.int64), ordered[starts], np.append(starts, len(places)), places)

    def to_bytes(self) -> list[bytes]:
        return [getattr(self, c).tobytes() for c in self.COLUMNS]

    @classmethod
    def from_bytes(cls, counts: bytes, terms: bytes, starts: bytes, places: bytes) -> Index:
        return cls(np.frombuffer(counts, np.int64), np.frombuffer(terms, np.uint64), np.frombuffer(starts, np.int64), np.frombuffer(places, np.int32))

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of some terms here; of those that do not occur, one past the last, which has no postings."""
        at = np.searchsorted(self.terms, terms)
        found = at < len(self.terms)
        found[found] = self.terms[at[found]] == terms[found]
        return np.where(found, at, len(self.terms))

    def frequency(self, numbers: np.ndarray) -> np.ndarray:
        return self.ends[numbers + 1] - self.ends[numbers]

    def postings(self, number: int) -> np.ndarray:
        return self.places[self.starts[number] : self.starts[number + 1]].astype(np.int64)

    def exact(self, phrase: np.ndarray) -> np.ndarray:
        """Places where the phrase starts, all its words in one text."""
        often = self.frequency(phrase)
        order = np.argsort(often, kind="stable")
        if not often[order[0]]:
            return np.zeros(0, np.int64)
        at = self.postings(phrase[order[0]]) - order[0]
        at = at[(at >= 0) & (at + len(phrase) <= self.size)]
        at = at[self.text[at] == self.text[at + len(phrase) - 1]] if len(at) else at
        for k in order[1:]:
            if not len(at):
                break
            there = self.postings(phrase[k])
            to = np.searchsorted(there, at + k)
            to[to == len(there)] = 0
            at = at[there[to] == at + k]
        return at

    def near(self, phrase: np.ndarray, slack: int) -> np.ndarray:
        """Places of the phrase's rarest term with every other term of it within slack words, in the same text."""
        often = self.frequency(phrase)
        order = np.argsort(often, kind="stable")
        if not often[order[0]]:
            return np.zeros(0, np.int64)
        at = self.postings(phrase[order[0]])
        for k in order[1:]:
            low, high = np.maximum(at - slack, self.bounds[self.text[at]]), np.minimum(at + slack, self.bounds[self.text[at] + 1] - 1)
            there = self.postings(phrase[k])
            at = at[np.searchsorted(there, low) < np.searchsorted(there, high, "right")]
        return at


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """The items as (id as text, text), BLOCK_BYTES at a time; the driver holds one block."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        text = r.text.encode()
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r.item or "", text))
        size += len(text)
    yield block


def _found(index: Index, phrases: Phrases, slack: int | None) -> tuple[pa.Array, pa.Array] | None:
    """Of a shard: spans of hit words (text, start, end), disjoint and in order, and items (text, item); None if none."""
    numbers = index.numbers(phrases.terms)
    begins, lengths, of_text, of_item = [], [], [], []
    rare = np.minimum.reduceat(index.frequency(numbers)[phrases.flat], phrases.begins) if phrases.phrases else np.zeros(0, np.int64)
    for k in np.flatnonzero(rare):
        phrase, owners = numbers[phrases.phrases[k]], phrases.owners[k]
        at = index.exact(phrase) if slack is None else index.near(phrase, slack)
        if len(at):
            begins.append(at)
            lengths.append(np.full(len(at), len(phrase) if slack is None else 1))
            of_text.append(np.repeat(index.text[at], len(owners)))
            of_item.append(np.tile(owners, len(at)))
    if not begins:
        return None
    edges = np.zeros(index.size + 1, np.int64)
    s, w = np.concatenate(begins), np.concatenate(lengths)
    np.add.at(edges, s, 1)
    np.add.at(edges, s + w, -1)
    hit = np.cumsum(edges[:-1]) > 0
    first = np.zeros(index.size + 1, bool)
    first[index.bounds] = True  # runs of hit words are cut where texts end
    start = np.flatnonzero(hit & (~np.concatenate(([False], hit[:-1])) | first[:-1]))
    end = np.flatnonzero(hit & (~np.concatenate((hit[1:], [False])) | first[1:])) + 1
    owner = index.text[start]
    spans = pa.StructArray.from_arrays([int64(owner), int64(start - index.bounds[owner]), int64(end - index.bounds[owner])], ["text", "start", "end"])
    pairs = np.unique(np.stack([np.concatenate(of_text), np.concatenate(of_item)], 1), axis=0)
    items = pa.StructArray.from_arrays([int64(pairs[:, 0]), pa.array(phrases.items, pa.string()).take(pa.array(pairs[:, 1]))], ["text", "item"])
    return spans, items


_SPANS, _ITEMS = "array<struct<text:long,start:long,end:long>>", "array<struct<text:long,item:string>>"


def build_index(picked: DataFrame) -> DataFrame:
    """The index of a table of row (struct) and text: rows array, and the postings of these rows' texts; a row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary(batch.column(1))
            for a, b in in_chunks(texts, SHARD_BYTES):
                rows = list_array(np.array([0, b - a]), batch.column(0).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([rows, *[pa.array([x], pa.binary()) for x in Index.build(texts[a:b]).to_bytes()]], ["rows", *Index.COLUMNS])

    return picked.mapInArrow(run, f"rows array<{picked.schema['row'].dataType.simpleString()}>, " + ", ".join(f"{c} binary" for c in Index.COLUMNS))


def search_index(index: DataFrame, block: list[tuple[str, bytes]], n: int = WINDOW, slack: int | None = None) -> DataFrame:
    """shard, spans, items of the shards of a stored index (with a column shard) that a block hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block, n)
        for batch in batches:
            for i in range(batch.num_rows):
                found = _found(Index.from_bytes(*[batch[c][i].as_py() for c in Index.COLUMNS]), phrases, slack)
                if found:
                    lists = [list_array(np.array([0, len(x)]), x) for x in found]
                    yield pa.RecordBatch.from_arrays([batch["shard"].slice(i, 1), *lists], ["shard", "spans", "items"])

    return index.select("shard", *Index.COLUMNS).mapInArrow(run, f"shard long, spans {_SPANS}, items {_ITEMS}")


def _by_row(shards: DataFrame) -> DataFrame:
    """row, n_words, hits, items of every row of every shard (rows, counts, spans, items; the last two null without hits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.frombuffer(batch["counts"][i].as_py(), np.int64)
                hits, items = [[] for _ in counts], [set() for _ in counts]
                for x in sorted(batch["spans"][i].as_py() or [], key=lambda x: (x["text"], x["start"])):
                    mine = hits[x["text"]]
                    if mine and x["start"] <= mine[-1]["end"]:
                        mine[-1]["end"] = max(mine[-1]["end"], x["end"])
                    else:
                        mine.append({"start": x["start"], "end": x["end"]})
                for x in batch["items"][i].as_py() or []:
                    items[x["text"]].add(x["item"])
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch["rows"].slice(i, 1).flatten(), int64(counts), pa.array(hits, span), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["row", "n_words", "hits", "items"])

    row = shards.schema["rows"].dataType.elementType.simpleString()
    return shards.mapInArrow(run, f"row {row}, n_words long, hits array<struct<start:long,end:long>>, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, slack: int | None = None, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row struct (docs' columns, or those in keep), n_words, hits, items: for each row of docs.

    hits: spans of word numbers inside any occurrence of a window of n words of an item (an item of fewer words, but not
    none, is one window); items: the ids, as texts, of items with such windows, distinct, sorted as strings.  With slack,
    hits are the places of a window's rarest term that has all its other terms within slack words.

    Words are runs of letters and digits with A-Z lower-cased; null and empty texts have none, on either side.  Repeated
    rows give repeated results; a null item id counts as the empty text; an empty benchmark hits nothing; an empty table
    gives none.  A text longer than a shard is a shard of its own.  Other columns stand inside row, so no name clashes.
    """
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    picked = bounded_batches(docs).select(row, F.col(f"`{text_col}`").cast("string").alias("text"))
    index = saved(build_index(picked).withColumn("shard", F.monotonically_increasing_id()))
    parts = [saved(search_index(index, block, n, slack)) for block in _blocks(benchmark, item_col, item_text_col)]
    found = reduce(DataFrame.unionAll, parts).groupBy("shard").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    found = saved(found)
    for part in parts:
        forget(part)
    return _by_row(index.select("shard", "rows", "counts").join(found, "shard", "left").select("rows", "counts", "spans", "items"))


def n_hit(hits) -> F.Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
