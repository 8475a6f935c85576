"""Near-duplicate classes by weighted MinHash signatures from thrown darts.

A document is a weighted set: its distinct shingles of SHINGLE words, each with the number of times it occurs.  Words are
runs of letters and digits with A-Z lower-cased, so that a copy whose punctuation was changed keeps its shingles; a text
without any is compared by what stands between its white space.

Darts fall on the plane of each element, weight by rank, as a Poisson process that is a function of the element alone (a
hash decides where).  The weight axis is cut into regions that double in width, so an element of weight w has about log w
of them; a region's darts come by rising rank, each at a place of the region's width.  A set is hit by the darts below
its elements' weights; each dart belongs to one of the signature's coordinates, and the earliest hit, by rank, is the
coordinate's value.  Two sets agree at a coordinate with the probability of their weighted Jaccard similarity.  Darts are
thrown up to a rank that yields about k (ln k + 3) hits whatever the set's size, so that a signature takes time in
proportion to the elements plus that; a set that leaves a coordinate empty raises its rank.

Bands of rows of a signature are joined.  Exact copies are one text from the start.  Each text is linked to the least
text of each of its buckets, and each link is checked on the sets themselves.  Where a bucket still holds texts of
several components after that, its texts are compared block by block, so that no link that the bands find is lost and no
bucket is one task's.  Classes are the connected components of the links that hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD_ALNUM, U64, WORD_BASE, Words, binary, bounded_batches, forget, in_chunks, list_array, mix, saved, signed, spans_hash
from .components import connected_components

SHINGLE, SIMILARITY = 5, 0.8
#: 25 bands of 5 rows: a pair at 0.8 is missed with a probability of 5e-5, one at 0.85 of 8e-7.
BANDS, ROWS = 25, 5
#: Stands for a null id while ids are compared: after all others.
NO_ID = 2**63 - 1
#: Texts of one bucket that are compared with each other in one task, at a time.
BLOCK = 256


_LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")


def words_of(texts: list[bytes]) -> Words:
    """The words of some texts.  Where there is no letter or digit, each run of other characters is one (spelled in digits
    behind a byte that no text holds)."""
    return Words([t if _LETTER.search(t) else b" ".join(b"\xff" + w.hex().encode() for w in t.split()) for t in texts], FOLD_ALNUM)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: the text, the shingle's hash, how often.  A text of fewer than n words is one."""
    starts = words.windows(n)
    hashes = words.window_hashes(starts, n)
    text = words.text[starts]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        hashes = np.concatenate((hashes, words.window_hashes(words.bounds[short], words.counts[short])))
        text = np.concatenate((text, short))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(text) != 0) | (hashes[1:] != hashes[:-1])))) if len(text) else np.zeros(0, np.int64)
    return text[new], hashes[new], np.diff(np.concatenate((new, [len(text)])))


def uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1], from 53 bits."""
    return ((h >> U64(11)) + U64(1)).astype(np.float64) * 2.0**-53


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """(n_texts, k) values; the rows of texts without elements are 0.  Weights are any positive numbers.

    Region 0 of an element is the weights below 1, region v those from 2^(v-1) to 2^v.  The ranks of a region's darts are
    sums of exponential steps by its width, each from a hash of element, region and step.
    """
    out = np.zeros((n_texts, k), U64)
    total = np.bincount(text, weights=weight, minlength=n_texts)
    bound = np.divide(k * (np.log(k) + 3), total, out=np.zeros(n_texts), where=total > 0)
    regions = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    cell_of = np.repeat(np.arange(len(text)), regions)
    number = np.arange(len(cell_of)) - np.repeat(np.cumsum(regions) - regions, regions)
    low, height = np.where(number > 0, 2.0 ** (number - 1), 0.0), weight[cell_of]
    width = np.maximum(low, 1.0)
    seed, owner = mix(element[cell_of] + number.astype(U64) * U64(0x9E3779B97F4A7C15)), text[cell_of]
    open_ = total > 0
    while open_.any():
        live = np.flatnonzero(open_[owner])
        rank, dart = np.zeros(len(live)), seed[live]
        ranks, darts, owners = [], [], []
        while len(live):
            dart = mix(dart + U64(0xA0761D6478BD642F))
            rank = rank - np.log(uniform(dart)) / width[live]
            inside = rank <= bound[owner[live]]
            live, rank, dart = live[inside], rank[inside], dart[inside]
            hit = low[live] + width[live] * uniform(mix(dart ^ U64(0x9FB21C651E98DF25))) <= height[live]
            ranks.append(rank[hit])
            darts.append(dart[hit])
            owners.append(owner[live[hit]])
        rank, dart, own = np.concatenate(ranks), np.concatenate(darts), np.concatenate(owners)
        name = mix(dart ^ U64(0x5851F42D4C957F2D))
        slot = own * k + (name % U64(k)).astype(np.int64)
        order = np.lexsort((rank, slot))
        slot, name = slot[order], name[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))) if len(slot) else np.zeros(0, np.int64)
        filled = np.bincount(slot[first] // k, minlength=n_texts) == k
        good = first[filled[slot[first] // k]]
        out.reshape(-1)[slot[good]] = name[good]
        open_ &= ~filled
        bound *= 2
    return out


def identities(words: Words) -> tuple[pa.Array, pa.Array]:
    """p1, p2: 128 bits of each text's words in order; 0, 0 without words."""
    starts, ends, has = words.bounds[:-1], words.bounds[1:], words.counts > 0
    return tuple(signed(np.where(has, spans_hash(h, starts, ends, WORD_BASE), U64(0))) for h in (words.hashes, mix(words.hashes ^ U64(0x2545F4914F6CDD1D))))


def _sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc, p1, p2 (the text's identity), bands array<long>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary(batch.column(1))
            for a, b in in_chunks(raw, 1 << 19):
                words = words_of(raw[a:b])
                text, element, weight = shingles(words, n)
                sig = signatures(text, element, weight, b - a, bands * rows)
                keys = np.zeros((b - a, bands), U64)
                for r in range(rows):
                    keys = mix(keys * U64(WORD_BASE) + sig.reshape(b - a, bands, rows)[:, :, r])
                has = words.counts > 0
                some = np.where(has, bands, 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *identities(words), list_array(np.concatenate(([0], np.cumsum(some))), signed(keys[has].reshape(-1)))], ["doc", "p1", "p2", "bands"])

    return docs.mapInArrow(run, "doc long, p1 long, p2 long, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """p1, p2, elements binary (sorted hashes), weights binary (int32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary(batch.column(1))
            for a, b in in_chunks(raw):
                words = words_of(raw[a:b])
                text, element, weight = shingles(words, n)
                ends = np.searchsorted(text, np.arange(b - a + 1))
                parts = list(zip(ends[:-1], ends[1:], strict=True))
                yield pa.RecordBatch.from_arrays([*identities(words), pa.array([element[i:j].tobytes() for i, j in parts], pa.binary()), pa.array([weight[i:j].astype(np.int32).tobytes() for i, j in parts], pa.binary())], ["p1", "p2", "elements", "weights"])

    return docs.mapInArrow(run, "p1 long, p2 long, elements binary, weights binary")


def similarity(a: bytes, wa: bytes, b: bytes, wb: bytes) -> float:
    """Weighted Jaccard of two sets as _sets() has them."""
    x, u, y, v = np.frombuffer(a, U64), np.frombuffer(wa, np.int32), np.frombuffer(b, U64), np.frombuffer(wb, np.int32)
    if not len(x) or not len(y):
        return 0.0
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    same = x[at] == y
    common = np.minimum(u[at[same]], v[same]).sum()
    return float(common / (u.sum() + v.sum() - common))


def _checked(links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The links (a, b) between texts at least so similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, u, y, v = (batch.column(i).to_pylist() for i in range(2, 6))
            holds = pa.array([similarity(*q) >= least - 1e-12 for q in zip(x, u, y, v, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(holds), batch.column(1).filter(holds)], ["a", "b"])

    left = sets.select(F.col("text").alias("a"), F.col("elements").alias("x"), F.col("weights").alias("u"))
    right = sets.select(F.col("text").alias("b"), F.col("elements").alias("y"), F.col("weights").alias("v"))
    return links.join(left, "a").join(right, "b").select("a", "b", "x", "u", "y", "v").mapInArrow(run, "a long, b long")


def _across(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between texts of one bucket (key) and different components, as similar as that.

    A bucket's members are dealt to blocks of about BLOCK; each pair of blocks is one group.  Only links that hold leave
    a group, and of these no more than join what it has not joined already.
    """
    sizes = saved(members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n")))
    sized = members.join(sizes, "key")  # both sides are tables as written, so that hot partitions can be split
    own = F.pmod(F.xxhash64("text"), F.col("n")).cast("int")
    dealt = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "text", "component").join(sets, "text")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        own, text, component = (table[c].to_numpy() for c in ("own", "text", "component"))
        sets = [(np.frombuffer(x, U64), np.frombuffer(w, np.int32).astype(np.int64)) for x, w in zip(table["elements"].to_pylist(), table["weights"].to_pylist(), strict=True)]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
        elements, weights = (np.concatenate(x) if sets else np.zeros(0, U64) for x in zip(*sets, strict=True))
        total = np.bincount(owner, weights=weights, minlength=len(sets))
        root = {c: c for c in component.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        found, begins = [], np.concatenate(([0], np.cumsum([len(x) for x, _ in sets])))
        for p, (x, w) in enumerate(sets[:-1], start=1):
            # the set p - 1 against all after it at once
            rest, n = elements[begins[p] :], len(sets) - p
            at = np.searchsorted(x, rest)
            at[at == len(x)] = 0
            same = np.flatnonzero(x[at] == rest) if len(x) else np.zeros(0, np.int64)
            common = np.bincount(owner[begins[p] :][same] - p, weights=np.minimum(w[at[same]], weights[begins[p] :][same]), minlength=n)
            near = common >= (least - 1e-12) * (total[p - 1] + total[p:] - common)
            if key[1] != key[2]:
                near &= own[p:] != own[p - 1]
            for q in np.flatnonzero(near & (common > 0)) + p:
                a, b = find(int(component[p - 1])), find(int(component[q]))
                if a != b:
                    found.append((int(text[p - 1]), int(text[q])))
                    root[a] = b
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc long, p1, p2, class_id long: one row for each row of docs; class_id is the least id of the class.

    Texts of the same words in the same order are one class; so are texts linked by a weighted Jaccard similarity of
    their shingles of at least that much.  Texts without words (null, empty, white space) are classes by themselves, as
    is a text with fewer than n words unless another has the same.  A text of any length is one row of a task.  Ids are
    integers.  A null id stays null and is no one's copy but by its text; a class of null ids only has the class_id null.
    Different texts under one id are one document: a link of either is a link of both.  Repeated rows are one text and
    come back as often; an empty table gives none; other columns are not read.
    """
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return _classes(docs, similarity, n, bands, rows, id_col, text_col).select(known("doc"), "p1", "p2", known("class_id"))


def _key(id_col: str):
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))


def _classes(docs: DataFrame, similarity: float = SIMILARITY, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What near_duplicates() gives, written, with NO_ID for null, and near: a number of the texts linked by their words
    alone, whatever ids they have; null without words.  Texts have numbers of their own, since an id can have several."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = bounded_batches(docs).select(_key(id_col).alias("doc"), text.alias("text"))
    sketches = saved(_sketches(source, n, bands, rows))
    texts = saved(sketches.where("p1 <> 0 or p2 <> 0").groupBy("p1", "p2").agg(F.min("doc").alias("doc"), F.first("bands").alias("bands")).withColumn("text", F.monotonically_increasing_id()))
    keyed = texts.select("text", F.posexplode("bands").alias("band", "hash")).select("text", F.xxhash64("band", "hash").alias("key"))
    shared = saved(keyed.groupBy("key").agg(F.min("text").alias("least"), F.count("*").alias("c")).where("c > 1").select("key", "least"))
    members = saved(keyed.join(shared, "key").select("key", "text", "least"))
    links = members.where("text <> least").select(F.col("text").alias("a"), F.col("least").alias("b")).distinct()
    involved = texts.join(members.select("text").distinct(), "text", "left_semi").select("text", "p1", "p2", "doc")
    chosen = source.join(involved.select("doc").distinct(), "doc", "left_semi").select("doc", "text")
    sets = _sets(chosen, n).groupBy("p1", "p2").agg(F.first(F.struct("elements", "weights")).alias("s"))
    sets = saved(sets.join(involved, ["p1", "p2"]).select("text", "s.elements", "s.weights"))
    held = saved(_checked(links, sets, similarity))
    labels = connected_components(held, "a", "b")
    marked = members.join(labels, F.col("text") == F.col("node"), "left").select("key", "text", F.coalesce("component", "text").alias("component"))
    marked = saved(marked)
    mixed = saved(marked.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q").select("key"))
    left_over = saved(marked.join(mixed, "key", "left_semi"))
    more = None
    if not left_over.isEmpty():
        more = saved(_across(left_over, sets, similarity))
        if not more.isEmpty():
            forget(labels)
            labels = connected_components(held.unionAll(more), "a", "b")
    linked = saved(labels.join(texts.select("text", "doc"), F.col("node") == F.col("text")).select("node", "component", "doc"))
    leads = saved(linked.groupBy("component").agg(F.min("doc").alias("lead")))
    linked_to = linked.join(leads, "component").select("node", "component", "lead")
    named = saved(texts.select("p1", "p2", "text", "doc").join(linked_to, F.col("text") == F.col("node"), "left").select("p1", "p2", F.coalesce("component", "text").alias("near"), F.coalesce("lead", "doc").alias("class_id")))
    out = saved(sketches.select("doc", "p1", "p2").join(named, ["p1", "p2"], "left").select("doc", "p1", "p2", F.coalesce("class_id", "doc").alias("class_id"), "near"))
    for done in (sketches, texts, shared, members, sets, held, labels, marked, mixed, left_over, more, linked, leads, named):
        forget(done)
    return _one_document(out)


def _one_document(classes: DataFrame) -> DataFrame:
    """The same with the classes made one in which texts of one id are; null is no id."""
    several = classes.where("near is not null").where(F.col("doc") != NO_ID).groupBy("doc").agg(F.min("near").alias("first"), F.max("near").alias("last")).where("first <> last").select("doc", "first")
    several = saved(several)
    if several.isEmpty():
        forget(several)
        return classes
    edges = saved(classes.join(several, "doc").where("near <> first").select("near", "first").distinct())
    forget(several)
    if edges.isEmpty():
        forget(edges)
        return classes
    groups = connected_components(edges, "near", "first").select(F.col("node").alias("near"), F.col("component").alias("group"))
    least = saved(classes.join(groups, "near").groupBy("near", "group").agg(F.min("class_id").alias("class_id")))
    leads = least.groupBy("group").agg(F.min("class_id").alias("lead"))
    led = saved(least.join(leads, "group").select("near", "lead"))
    out = saved(classes.join(led, "near", "left").select("doc", "p1", "p2", F.coalesce("lead", "class_id").alias("class_id"), "near"))
    for done in (edges, least, led, classes):
        forget(done)
    return out


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs, of each class only the row of the least id; of rows that repeat this id, one for each text that is no near
    copy of another of them.  Of a class of null ids only, one row stays.

    Rows without words stay, each id a class of its own.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    classes = _classes(docs, **options)
    leads = classes.where("doc = class_id")
    first = saved(leads.groupBy(F.col("doc").alias("_k")).agg((F.countDistinct("p1", "p2") > 1).alias("_several")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    kept = docs.select(row, _key(id_col).alias("_k"), F.col(f"`{text_col}`").cast("string").alias("_text")).join(first, "_k")
    by_text = lambda c: c.groupBy("_k", "_text").agg(F.min("_row").alias("_row"))
    hard = F.col("_several") | (F.col("_k") == NO_ID)
    plain = by_text(kept.where(~hard)).groupBy("_k").agg(F.min("_row").alias("_row"))
    if first.where(hard).isEmpty():
        return plain.select("_row.*")
    texts = saved(leads.select(F.col("doc").alias("_k"), "p1", "p2", "near").distinct())
    again = _identified(by_text(kept.where(hard))).join(texts, ["_k", "p1", "p2"])
    again = again.groupBy("_k", "near", F.when(F.col("near").isNull(), F.col("_text")).alias("_t")).agg(F.min("_row").alias("_row"))
    return plain.select("_row.*").unionAll(again.select("_row.*"))


def _identified(kept: DataFrame) -> DataFrame:
    """_k, _text, _row, and the text's p1 and p2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary(batch.column(1))
            for a, b in in_chunks(raw):
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *identities(words_of(raw[a:b]))], ["_k", "_text", "_row", "p1", "p2"])

    picked = kept.select("_k", "_text", "_row")
    return picked.mapInArrow(run, f"_k long, _text string, _row {picked.schema['_row'].dataType.simpleString()}, p1 long, p2 long")


__all__ = ["BANDS", "ROWS", "SHINGLE", "SIMILARITY", "keep_one", "near_duplicates", "shingles", "signatures", "similarity"]
