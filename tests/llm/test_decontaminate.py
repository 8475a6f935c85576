import hashlib
import re
import string

from helpers import DATA

from pageloom.llm import decontaminate, queries

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(docs, items, n=13):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows, out = {}, []
    for k, t in items:
        w = find((t or "").translate(LOW))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if k is None else str(k))
    for k, t in docs:
        w, found = find((t or "").translate(LOW)), set()
        hit = [False] * len(w)
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[i : i + size]))) is not None:
                    found |= own
                    hit[i : i + size] = [True] * size
        out.append((k, len(w), sum(hit), sorted(found)))
    return sorted(out, key=repr)


def ours(df, items, **options):
    out = decontaminate.decontaminate(df, items, **options).select("row.doc_id", "n_words", decontaminate.n_hit(decontaminate.F.col("hits")).alias("h"), "items")
    return sorted(map(tuple, out.collect()), key=repr)


LONG = " ".join(f"t{i % 9}{i % 4}" for i in range(40))
ITEMS = [(1, LONG), (2, "Short One é"), (3, None), (4, " .,; "), (10, LONG), (None, "null id")]
DOCS = [
    (1, f"x {LONG} y"), (2, LONG[:50]), (3, "a SHORT, one... é b short one É"), (4, None), (5, ""), (6, "..."), (7, f"{LONG} {LONG}"), (7, f"{LONG} {LONG}"), (8, "short one"), (9, "é short one é" * 300),
    (11, "null\x00id"), (12, LONG.replace(" ", "-").upper()),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_cases(spark, docs):
    assert ours(docs(DOCS, n_words="a", hits="b", items="c"), items(spark)) == brute(DOCS, ITEMS)
    assert ours(docs(DOCS, n_words="a", hits="b", items="c", _k="d"), items(spark)) == brute(DOCS, ITEMS)


def test_a_match_does_not_cross_documents(spark, docs):
    rows = [(i, x) for i, x in enumerate(["short", "one é", "short one", "é"])]
    assert all(h == 0 for _, _, h, _ in ours(docs(rows, parts=1), items(spark)))


def test_blocks_of_a_large_benchmark(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20)
    assert ours(docs(DOCS), items(spark)) == brute(DOCS, ITEMS)


def test_small_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 10)
    assert ours(docs(DOCS), items(spark)) == brute(DOCS, ITEMS)


def test_empty_tables(spark, docs):
    assert ours(docs([]), items(spark)) == []
    assert ours(docs(DOCS), items(spark, [])) == brute(DOCS, [])


def test_proximity(spark, docs):
    near = [(1, "alpha beta gamma")]
    rows = [(1, "gamma x alpha y beta"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "alpha beta")]
    assert [h > 0 for _, _, h, _ in ours(docs(rows), items(spark, near), slack=4)] == [True, False, False]


def test_query(spark, duck):
    want = brute(duck.sql("select doc_id, text from documents").fetchall(), duck.sql("select item_id, text from benchmark").fetchall())
    rows = [(k, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0 and 20 * h >= n) for k, n, h, i in want]
    assert sorted(map(tuple, queries.op2_decontamination(spark, DATA).collect())) == sorted(rows)
    assert any(h for _, _, h, _ in want)
