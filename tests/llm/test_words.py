import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pageloom.llm import common as c

TEXT = st.text(st.sampled_from(list("abAB09 \t\n\x0b\x1cé中🙂._\x00")), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_words_are_those_of_the_patterns(texts):
    raw = [t.encode() for t in texts]
    for table, pattern in ((c.KEEP, rb"[^\x20\x09-\x0D]+"), (c.FOLD_ALNUM, rb"[0-9A-Za-z\x80-\xff]+")):
        w = c.Words(raw, table)
        joined = b"\n".join(raw)
        want = [re.findall(pattern, t) for t in raw]
        got = [[joined[s:e] for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        assert got == want


def test_equal_words_have_equal_hashes_wherever_they_stand():
    w = c.Words([b"one two", b"", b"x two one  one"], c.KEEP)
    one, two, x = w.hashes[0], w.hashes[1], w.hashes[2]
    assert list(w.hashes) == [one, two, x, two, one, one] and len({one, two, x}) == 3
    assert list(w.counts) == [2, 0, 4]


def test_windows_stay_in_their_text():
    w = c.Words([b"a b c", b"d e", b"a b c d"], c.KEEP)
    assert list(w.windows(3)) == [0, 5, 6]
    h = w.window_hashes(w.windows(3), 3)
    assert h[0] == h[1] != h[2]


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    data = (b"abc " * 500 + b"x" * 3000 + b" end") * 3
    s, e, h = c.hash_words(data, c.KEEP)
    monkeypatch.setattr(c, "CHUNK_BYTES", 257)
    s2, e2, h2 = c.hash_words(data, c.KEEP)
    assert np.array_equal(s, s2) and np.array_equal(e, e2) and np.array_equal(h, h2)


def test_chunks_cover_all():
    texts = [b"x" * n for n in (5, 0, 90, 3, 3, 200, 1)]
    assert [i for a, b in c.in_chunks(texts, 50) for i in range(a, b)] == list(range(7))
