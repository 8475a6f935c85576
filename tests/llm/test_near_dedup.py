import collections
import random
import re

import numpy as np
from helpers import DATA

from pageloom.llm import dart_minhash, queries
from pageloom.llm.dart_minhash import keep_one, near_duplicates


def weights(text, n=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) or (text or "").split()
    return collections.Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1) if w else 0))


def jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute(rows, least=0.8):
    sets = [weights(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and not set(a).isdisjoint(sets[j]) and jaccard(a, sets[j]) >= least:
                root[find(i)] = find(j)
    least_id = {}
    for i, (k, _) in enumerate(rows):
        least_id[find(i)] = min(least_id.get(find(i), k), k)
    return sorted((k, least_id[find(i)]) for i, (k, _) in enumerate(rows))


def ours(df, **options):
    return sorted(((r.doc, r.class_id) for r in near_duplicates(df, **options).collect()), key=repr)


def corpus(seed=1, families=12, size=12):
    rnd, rows = random.Random(seed), []
    for f in range(families):
        base = [f"f{f}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([30, 120, 400]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 999)}"
            rows.append(" ".join(words))
    rnd.shuffle(rows)
    return list(enumerate(rows))




def test_classes_are_the_components_of_all_links(docs):
    rows = corpus()
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "one two"), (1004, "one two"), (1005, "two one"), (2000, rows[0][1])]
    assert ours(docs(rows, bands="a", rep="b", class_id="c", doc="d")) == sorted(brute(rows), key=repr)


def test_large_group_of_near_copies(docs, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK", 8)
    rows = corpus(seed=5, families=2, size=150)
    assert ours(docs(rows)) == sorted(brute(rows), key=repr)


def test_repeated_rows_and_empty(docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "z y x w v u"), (3, "z y x w v u")]
    assert ours(docs(rows)) == sorted([(None, 3), (1, 1), (1, 1), (2, 1), (3, 3)], key=repr)
    assert sorted((str(r.doc_id), r.lang, r.row) for r in keep_one(docs(rows, row="k", _k="m")).collect()) == [("1", None, "k"), ("3", None, "k")]
    assert ours(docs([])) == [] and keep_one(docs([])).count() == 0


def test_several_texts_of_one_id(docs):
    def text(name, change=None):
        return " ".join(change if change and i == 50 else f"{name}{i}" for i in range(100))

    rows = [
        (None, text("a")), (None, text("b")), (None, text("c")), (None, text("c", "x")), (None, "  " + text("c")), (1, text("a", "y")), (3, text("c", "z")),
        (10, text("d")), (10, text("e")), (11, text("e", "x")), (9, text("d", "x")), (12, text("f")),
        (20, text("g")), (21, text("g")), (21, text("h")), (22, text("h", "x")), (None, ""), (None, text("i")), (None, text("i", "x")),
    ]
    want = [(None, 1), (None, None), (None, 3), (None, 3), (None, 3), (1, 1), (3, 3), (9, 9), (10, 9), (10, 9), (11, 9), (12, 12), (20, 20), (21, 20), (21, 20), (22, 20), (None, None), (None, None), (None, None)]
    assert ours(docs(rows)) == sorted(want, key=repr)
    kept = [(r.doc_id, r.text.split()[:1]) for r in keep_one(docs(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(None, ["b0"]), (None, ["i0"]), (None, []), (1, ["a0"]), (3, ["c0"]), (9, ["d0"]), (12, ["f0"]), (20, ["g0"])], key=repr)


def test_case_and_marks_do_not_matter_and_marks_alone_are_words(docs):
    rows = [(1, "One, two; three. FOUR five"), (2, "one two three four -- five!"), (3, "!!! ??? --"), (4, "!!!  ???\n--"), (5, "!!! ?? --"), (6, "212121 3f3f3f 2d2d")]
    assert ours(docs(rows)) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6)]


def test_a_large_bucket_of_texts_that_are_no_copies(docs, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK", 64)
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):  # most pairs agree to 0.7 or so, and in many bands
        words = list(base)
        for _ in range(2):
            words[rnd.randrange(60)] = f"x{rnd.randrange(4)}"
        rows.append((i, " ".join(words)))
    assert ours(docs(rows)) == sorted(brute(rows), key=repr)


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(8)
    k, elements = 400, rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 6, 300), rng.integers(1, 6, 300)
    b[:120] = a[:120]
    sig = dart_minhash.signatures(np.repeat([0, 1], 300), np.concatenate((elements, elements)), np.concatenate((a, b)), 2, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (sig > 0).all() and abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5


def test_signature_of_one_heavy_and_of_many_light_elements():
    for n, w in ((1, 1), (1, 5000), (5000, 1)):
        sig = dart_minhash.signatures(np.zeros(n, np.int64), np.arange(1, n + 1).astype(np.uint64), np.full(n, w), 2, 125)
        assert (sig[0] > 0).all() and not sig[1].any()


def test_query(spark, duck):
    rows = duck.sql("select doc_id, text from documents").fetchall()
    inverted = collections.defaultdict(list)
    sets = {k: weights(t) for k, t in rows}
    for k, s in sets.items():
        for x in s:
            inverted[x].append(k)
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for v in inverted.values() if len(v) < 60 for a in v for b in v if a < b}:
        if find(a) != find(b) and jaccard(sets[a], sets[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert sorted(map(tuple, queries.op9_near_dedup(spark, DATA).collect())) == sorted((k, find(k)) for k in root)
