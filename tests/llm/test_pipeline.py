import base64
import re

import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from test_decontaminate import brute as decontaminated
from test_near_dedup import brute as classes
from test_substring_dedup import brute as cut

from pageloom.llm import queries

WORDS = [f"w{i}" for i in range(3000)]


def text(a, b):
    return " ".join(WORDS[a:b])


ROWS = [
    (1, text(0, 100)), (2, text(0, 100)), (3, text(0, 97) + " new words here"), (4, text(200, 300) + " own tail"), (5, "own head " + text(200, 260)), (6, text(0, 60) + " " + text(400, 450)), (7, None), (8, ""), (9, "123 456"),
    (10, text(500, 513)), (11, text(500, 513) + " " + text(600, 900)), (12, text(700, 750)),
]
ITEMS = [(1, text(500, 513))]


@pytest.fixture
def folder(spark, docs, tmp_path):
    docs(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_against_a_plain_version(spark, folder):
    rows = [(k, t) for k, t in ROWS if t and re.search("[^\\W\\d_]", t)]
    rows = [(k, t) for (k, t), (_, c) in zip(sorted(rows), classes(rows), strict=True) if k == c]
    was = dict(rows)
    rows = [(k, kept if gone else was[k]) for k, n, gone, kept in cut(rows) if gone < n]
    rows = [(k, t) for (k, t), (_, n, hit, _) in zip(rows, sorted(decontaminated(rows, ITEMS)), strict=True) if not (hit and 20 * hit >= n)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(queries.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(k, len(ids := library.encode_ordinary(t)), ids) for k, t in rows]
    assert [k for k, _, _ in want] == [1, 4, 5, 6, 11]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == want


def test_stages_keep_the_columns_and_stand_empty_tables(spark, folder, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs([]), folder).columns == docs([]).columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "byte_bpe"]


def test_language_stage_learns_and_keeps(spark, folder, docs):
    de, en = "und die anderen schönen Wörter der Sprache", "the words of the other language and more"
    df = docs([(i, (de if i % 2 else en) + f" {i}") for i in range(120)] + [(500, "42"), (501, None)]).selectExpr("doc_id", "text", "CASE WHEN doc_id % 2 = 1 THEN 'de' ELSE 'en' END AS lang", "source", "n_chars")
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, df, folder).collect()) == list(range(120))
