"""Byte-level BPE as a monoid: halves are encoded by themselves and joined.

A list of tokens is the encoding of its bytes exactly if each pair of neighbours is the encoding of the pair's bytes.
(Merges are taken by rank; without a merge over a border both sides run as if alone, and whether one crosses a border
depends on the two tokens beside it only, since any interleaving of several sides holds the interleaving of two.)
So two encodings join by encoding a window around the border anew, and a wider one until the tokens at both edges of
the window stand as neighbours of the tokens outside, which then provably stay.  Decoding is the concatenation of the
tokens' bytes up the same tree.

Null and empty texts have no tokens.  A text of any length is one tree for each match of the pattern; the matches of a
text are independent, so rows, order and repeated rows don't matter.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, in_chunks, list_array

#: Entries that a worker keeps of each kind, and the bytes of the longest text of one: so its memory is bounded by bytes.
KEPT, KEPT_BYTES = 300_000, 32
#: Bytes of text whose ids are sent back at once.
SLICE_BYTES = 1 << 20
#: Bytes of a window beyond which its pairs wait in a heap.
HEAP_BYTES = 48
#: A pattern in common use and, for texts of nothing but the characters that PLAIN allows, one that splits
#: them alike and needs no tables of Unicode properties.
COMMON = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS, _MARKS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧‰-⁞€"
PLAIN = re.compile(rf"[^{_LETTERS}{_MARKS}0-9 \n\r\t]")
COMMON_PLAIN = re.compile(rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_MARKS}]+| ?[0-9]+|\s+(?!\S)|\s+")
_codecs: dict[tuple[bytes, str], Codec] = {}


def read_ranks(path: str) -> bytes:
    """The vocabulary file, for Codec; read on the driver and sent along, as executors need not have it."""
    with open(path, "rb") as f:
        return f.read()


class _Matches(dict):
    """A match of the pattern -> its ids."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, match: str) -> tuple[int, ...]:
        piece = match.encode()
        rank = self.codec.ranks.get(piece)
        ids = (rank,) if rank is not None else self.codec.encode_bytes(piece)
        if len(piece) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[match] = ids
        return ids


class Codec:
    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in vocabulary.splitlines() if x)}
        self.tokens = {b: a for a, b in self.ranks.items()}
        self.split_any, self.common = regex.compile(pattern).findall, pattern == COMMON
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.matches = _Matches(self)

    # -- encoding

    def split(self, text: str) -> list[str]:
        return COMMON_PLAIN.findall(text) if self.common and not PLAIN.search(text) else self.split_any(text)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """A window, merge by merge: always the leftmost of the pairs with the least rank."""
        if len(piece) > HEAP_BYTES:
            return self.merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with the pairs in a heap and the parts in a linked list: n log n."""
        ranks, n = self.ranks, len(piece)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a byte
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = ends[i]
            if j <= i or j >= n or ends[j] != end:
                continue  # one of the two has grown or gone
            ends[i], ends[j] = end, -1
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
                heapq.heappush(heap, (r, k, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return tuple(out)

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        """The encoding of two tokens' bytes; (a, b) if they may stand side by side."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return got

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left + right
        window = self.pair(left[-1], right[0])
        if window == (left[-1], right[0]):
            return left + right
        n = 1
        while True:
            a, b = max(0, len(left) - n), min(len(right), n)
            if n > 1:
                window = self.merge(self.decode(left[a:] + right[:b]))
            stays_left = not a or self.pair(left[a - 1], window[0]) == (left[a - 1], window[0])
            if stays_left and (b == len(right) or self.pair(window[-1], right[b]) == (window[-1], right[b])):
                return left[:a] + window + right[b:]
            n *= 2

    def encode_bytes(self, piece: bytes, seen: dict[bytes, tuple[int, ...]] | None = None) -> tuple[int, ...]:
        """seen: the halves of this match, so that a run of one letter is encoded once for each length."""
        n = len(piece)
        if n < 2:
            return (self.ranks[piece],) if n else ()
        short = n <= KEPT_BYTES // 4
        seen = {} if seen is None else seen
        known = self.parts if short else seen
        ids = known.get(piece)
        if ids is None:
            half = 1 << ((n - 1).bit_length() - 1)  # a power of two, so that equal letters give equal halves
            ids = self.join(self.encode_bytes(piece[:half], seen), self.encode_bytes(piece[half:], seen))
            if short and len(known) >= KEPT:
                known.clear()
            if short or n > KEPT_BYTES:
                known[piece] = ids
        return ids

    def encode(self, text: str) -> array:
        return array("i", chain.from_iterable(map(self.matches.__getitem__, self.split(text))))

    # -- decoding

    def decode(self, ids) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) >> 1
        return self.decode(ids[:half]) + self.decode(ids[half:])


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """One for each worker process."""
    if (vocabulary, pattern) not in _codecs:
        _codecs.clear()
        _codecs[vocabulary, pattern] = Codec(vocabulary, pattern)
    return _codecs[vocabulary, pattern]


def encode(docs: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True, verify: bool = False) -> DataFrame:
    """doc_id, ids array<int>, and with decode, decoded binary: the ids of each whole text, and what they decode to.

    With verify, the ids of each text are decoded beside it, and it is an error if they don't give back the text; with
    verify and not decode, what they decode to is compared and goes no further.

    Works row by row without a shuffle; doc_id has the type of id_col, whatever that is, and null ids stay null.  A null
    text counts as empty; empty texts have no ids and decode to nothing.  Repeated rows give repeated results; an empty
    table gives none; columns but those two are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in in_chunks([x or "" for x in texts], SLICE_BYTES):
                ends, flat, decoded = [0], array("i"), []
                for i, x in enumerate(texts[a:b], a):
                    ids = c.encode(x) if x else array("i")
                    flat += ids
                    ends.append(len(flat))
                    back = c.decode(ids) if decode or verify else b""
                    if verify and back != (x or "").encode():
                        raise ValueError(f"the ids of doc_id {batch.column(0)[i].as_py()!r} don't decode to its text")
                    if decode:
                        decoded.append(back)
                columns = [batch.column(0).slice(a, b - a), list_array(ends, pa.array(memoryview(flat) if len(flat) else [], pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(decoded, pa.binary())] * decode, ["doc_id", "ids", "decoded"][: 2 + decode])

    picked = bounded_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", decoded binary" * decode)


def ids_text(ids: Column) -> Column:
    """Decimal ids, joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")


__all__ = ["Codec", "codec", "encode", "ids_text", "read_ranks"]
