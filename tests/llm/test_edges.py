"""Texts beyond one chunk, and stages over rows with nulls, repeats and columns whose names operators use."""

import hashlib

import corpus_pipeline
import pytest
from test_decontaminate import brute as decontaminated
from test_decontaminate import items
from test_decontaminate import ours as hits
from test_near_dedup import brute as classes
from test_near_dedup import ours as near
from test_substring_dedup import brute as cut
from test_substring_dedup import ours as kept

from pageloom.llm.common import CHUNK_BYTES

WORDS = [f"w{i * 7919 % 1000003}" for i in range(110_000)]
LONG = " ".join(WORDS)


@pytest.fixture
def long_texts():
    changed = [*WORDS[:500], "new", *WORDS[501:109_000], *["tail"] * 30]
    return [(1, LONG), (2, " ".join(changed)), (3, " ".join(["own", *WORDS[99_000:99_040]])), (4, None), (5, "x" * (CHUNK_BYTES + 9)), (6, LONG)]


def test_texts_of_several_chunks(spark, docs, long_texts):
    assert len(LONG) > CHUNK_BYTES
    assert kept(docs(long_texts)) == cut(long_texts)
    assert near(docs(long_texts)) == classes(long_texts)
    asked = [(1, " ".join(WORDS[70_000:70_020])), (2, " ".join(WORDS[108_990:109_010])), (3, "tail tail")]
    assert hits(docs(long_texts), items(spark, asked)) == decontaminated(long_texts, asked)


TEXT = " ".join(f"a{i}" for i in range(40))
ROWS = [(1, TEXT), (1, TEXT), (2, "short text"), (3, None), (4, ""), (5, "12 34"), (None, "of no id"), (6, TEXT + " and more words of its own")]
#: Of each stage, the ids that stay: without languages to learn from, texts with letters; one of the near copies; texts of
#: which something is left, rows of one id and place being none earlier than the other; texts that are not of the benchmark.
STAYS = {
    "language_id": [None, 1, 1, 2, 6],
    "near_dedup": [None, 1, 2, 3, 4, 5],
    "substring_dedup": [None, 1, 1, 2, 5, 6],
    "decontamination": [None, 1, 1, 3, 4, 5, 6],
}


@pytest.mark.parametrize("name", STAYS)
def test_stages_on_edges(spark, docs, tmp_path, name):
    spark.createDataFrame([(7, "Short TEXT"), (8, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = docs(ROWS, row="r", doc="d", class_id="c", n_words="n", spans="s", kept="k", score="x", hits="h", items="i")
    out = dict(corpus_pipeline.STAGES)[name](spark, df, str(tmp_path))
    assert out.columns == df.columns
    rows = out.collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: -1 if x is None else x) == STAYS[name]
    assert {(r.row, r.doc, r.class_id, r.n_words, r.spans, r.kept, r.score, r.hits, r["items"]) for r in rows} == {("r", "d", "c", "n", "s", "k", "x", "h", "i")}


def test_encoding_on_edges(spark, docs, tmp_path):
    out = corpus_pipeline.encode_tokens(spark, docs(ROWS, ids="i", n_tokens="n"), str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in out) == [(0, True), (1, True), (1, True), (2, True), (3, False), (4, False), (5, True), (6, True)]
    assert len({hashlib.sha256(repr(r.ids).encode()).hexdigest() for r in out if r.doc_id == 1}) == 1


def test_ids_that_lose_text_fail_the_stage(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.public_tokenizers, "PATTERN", r"\p{L}+")  # leaves out spaces
    assert corpus_pipeline.encode_tokens(spark, docs([(1, "word"), (2, None)]), str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="doc_id 3 don't decode to its text"):
        corpus_pipeline.encode_tokens(spark, docs([(1, "word"), (3, "two words")]), str(tmp_path)).collect()
