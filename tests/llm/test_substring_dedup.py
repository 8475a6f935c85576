import hashlib
import random
import re

from helpers import DATA

from pageloom.llm import queries
from pageloom.llm.substring_dedup import substring_dedup


def brute(rows, n=20):
    first, split = {}, [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    for k, w in split:
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, (k, i)), (k, i))
    out = []
    for k, w in split:
        hit = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < (k, i):
                hit[i : i + n] = [True] * n
        out.append((k, len(w), sum(hit), " ".join(x for x, h in zip(w, hit, strict=True) if not h)))
    return sorted(out)


def ours(df, **options):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(df, **options).select("row.doc_id", "n_words", "n_removed", "kept").collect())


def test_random_texts_with_runs_copies_and_edges(docs):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefgh") for _ in range(200)) for _ in range(5)]
    rows = []
    for i in range(120):
        p = []
        for _ in range(rnd.randint(0, 6)):
            s, k = rnd.choice(base).split(), rnd.randint(0, 170)
            p += s[k : k + rnd.randint(1, 60)] + ["a"] * rnd.choice([0, 0, 45]) + [rnd.choice("xyz") for _ in range(rnd.randint(0, 9))]
        rows.append((i, " ".join(p)))
    rows += [(200, None), (201, ""), (202, " \n\t "), rows[3], (300, rows[4][1])]
    assert ours(docs(rows, n_words="x", spans="y", kept="z", _k="w")) == brute(rows)
    assert ours(docs(rows), n=16) == brute(rows, 16)


def test_spans_are_maximal_and_in_order(docs):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[:30], "y", *words[50:80]]))]
    got = {r.row.doc_id: [(s.start, s.end) for s in r.removed] for r in substring_dedup(docs(rows)).collect()}
    assert got == {1: [], 2: [(1, 31), (32, 62)]}


def test_contents_whose_hashes_agree_in_32_bits_are_not_taken_for_copies(docs):
    hot = " ".join(f"h294130x{i}" for i in range(8))  # the anchor of all windows below

    def around(before, after):
        return " ".join([*(f"a{x}" for x in before), hot, *(f"b{x}" for x in after)])

    block = [  # the high 32 bits of their blocks' hashes agree
        (1, around([536751, 779313, 265396, 269111, 740044, 362996], [174511, 739903, 370174, 611666, 799065, 350611])),
        (2, around([879983, 636203, 841900, 184814, 257897, 841499], [995958, 657312, 739685, 767201, 733999, 232898])),
    ]
    window = [  # those of their windows'
        (3, around([984424, 494355, 743038, 717682, 268589, 364466], [691552, 750650, 345904, 783945, 282931, 11159])),
        (4, around([799061, 375400, 452362, 563914, 318093, 607371], [332504, 140403, 209180, 786661, 964203, 836143])),
    ]
    for rows in (block, window):
        assert ours(docs(rows)) == brute(rows) == [(k, 20, 0, t) for k, t in rows]


def test_empty_and_null_ids(docs):
    assert ours(docs([])) == []
    text = " ".join(f"w{i}" for i in range(25))
    got = {r.row.doc_id: r.n_removed for r in substring_dedup(docs([(None, text), (1, text)])).collect()}
    assert got == {None: 0, 1: 25}  # a null id comes first


def test_query(spark, duck):
    rows = duck.sql("select doc_id, text from documents").fetchall()
    want = [(k, n, m, hashlib.sha256(x.encode()).hexdigest()) for k, n, m, x in brute(rows)]
    assert sorted(map(tuple, queries.op1_substring_dedup(spark, DATA).collect())) == want
