import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from helpers import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from pageloom.llm import byte_bpe, queries

RAW = byte_bpe.read_ranks(P.path(queries.VOCABULARY))
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = byte_bpe.Codec(RAW, P.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text(st.sampled_from(list("aab \n\t'sé中🙂=-_<|>")), max_size=300))
def test_as_the_library(text):
    ids = list(CODEC.encode(text))
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=0x250), max_size=60) | st.text(st.sampled_from(list("ab' \t\n\r_-é×²½ªº¿€–…‿\u2009\u2028 01s'trevmld")), max_size=120))
def test_plain_texts_split_alike(text):
    assert byte_bpe.COMMON == P.PATTERN
    assert CODEC.split(text) == CODEC.split_any(text)


def test_every_plain_character_is_split_alike():
    plain = [c for c in map(chr, range(0x3000)) if not byte_bpe.PLAIN.search(c)]
    for c in plain:
        for text in (c, f"a{c}", f" {c}{c}1", f"'{c} {c}", f"{c}  {c}\n{c}_"):
            assert byte_bpe.COMMON_PLAIN.findall(text) == CODEC.split_any(text)
    assert len(plain) > 500


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a" * 5000, "=" * 3001, " " * 997 + "x", "ab" * 1500, "é" * 800, "\n" * 400, "lorem" * 700, "a" * 99_999, "ab" * 40_001, "abcde" * 3001 + "dcbaab" * 3000])
def test_long_matches(text):
    assert list(CODEC.encode(text)) == LIBRARY.encode_ordinary(text)


def test_joining_anywhere_gives_the_same():
    rnd = random.Random(1)
    for _ in range(300):
        piece = bytes(rnd.choice(b"abcdeent ion\xc3\xa9==") for _ in range(rnd.randint(2, 40)))
        cut = rnd.randint(1, len(piece) - 1)
        assert CODEC.join(CODEC.merge(piece[:cut]), CODEC.merge(piece[cut:])) == CODEC.merge(piece) == CODEC.encode_bytes(piece)


def test_kept_entries_are_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 7)
    c = byte_bpe.Codec(RAW, P.PATTERN)
    text = "some words that are encoded again and again, some words"
    assert list(c.encode(text)) == LIBRARY.encode_ordinary(text)
    assert max(map(len, (c.matches, c.pairs, c.parts))) <= 7


def test_table(docs):
    rows = [(1, None), (2, ""), (3, "Hello,  world\n"), (3, "Hello,  world\n"), (None, "x")]
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in byte_bpe.encode(docs(rows, ids="a", decoded="b"), RAW, P.PATTERN).collect()), key=repr)
    assert got == sorted(((k, LIBRARY.encode_ordinary(x or ""), (x or "").encode()) for k, x in rows), key=repr)
    assert byte_bpe.encode(docs([]), RAW, P.PATTERN).count() == 0


def test_query(spark, duck):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for k, x in duck.sql("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = LIBRARY.encode_ordinary(x)
        want.append((k, len(ids), sha(",".join(map(str, ids)).encode()), sha(x.encode())))
    assert sorted(map(tuple, queries.op4_byte_bpe(spark, DATA).collect())) == sorted(want)


def test_other_ids_and_no_decoding(spark):
    df = spark.createDataFrame([("x", "two words"), (None, None), ("y", "")], "doc_id string, text string")
    out = byte_bpe.encode(df, RAW, P.PATTERN, decode=False)
    assert out.columns == ["doc_id", "ids"]
    assert sorted((str(r.doc_id), r.ids) for r in out.collect()) == [("None", []), ("x", LIBRARY.encode_ordinary("two words")), ("y", [])]


def test_verified_ids(spark, docs):
    rows = [(1, None), (2, ""), (3, "Hello,  world\n\u2028中🙂"), (None, "x" * 20_000), (5, "two words " * 200_000)]
    out = byte_bpe.encode(docs(rows), RAW, P.PATTERN, decode=False, verify=True)
    assert out.columns == ["doc_id", "ids"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(((k, LIBRARY.encode_ordinary(x or "")) for k, x in rows), key=repr)
    both = byte_bpe.encode(docs(rows), RAW, P.PATTERN, verify=True).collect()
    assert {(r.doc_id, bytes(r.decoded)) for r in both} == {(k, (x or "").encode()) for k, x in rows}
    with pytest.raises(Exception, match="doc_id 3 don't decode to its text"):
        byte_bpe.encode(docs([(1, "word"), (3, "two words")]), RAW, r"\p{L}+", verify=True).collect()
