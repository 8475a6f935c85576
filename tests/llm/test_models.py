"""Language ID and quality: held-out accuracy, and what they do at the edges."""

import zlib

import numpy as np
from helpers import DATA

from pageloom.llm import language_id, queries, weak_quality


def test_language_accuracy_on_held_out(spark, duck):
    got = {r.doc_id: r for r in queries.op8_language_id(spark, DATA).collect()}
    told = duck.sql("select doc_id, lang, text from documents").fetchall()
    assert len(got) == len(told)
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= got[k].score <= 1 for k, _, _ in told)
    held = [got[k].lang_pred == lang for k, lang, _ in told if got[k].held_out]
    assert len(held) > 100 and np.mean(held) > 0.97


def test_language_edges(spark, docs):
    rows = [(i, f"the and of {i} with the other words that are here" if i % 2 else f"der die das {i} und mit den anderen schönen Wörtern") for i in range(200)]
    df = docs(rows, lang_pred="x", score="y", row="z").drop("lang")
    labelled = df.selectExpr("*", "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'de' ELSE 'en' END AS lang")
    model = language_id.train(labelled)
    assert model.languages == ["de", "en"]
    odd = [(1, None), (2, ""), (3, "123 !? \x00"), (4, "the words of the other"), (4, "the words of the other"), (None, "und die anderen Wörter"), (5, "the and of with words " * 20_000)]
    got = sorted((str(r.row.doc_id), r.lang_pred, r.score > 0.5) for r in language_id.predict(docs(odd, lang_pred="x", score="y", row="z"), model).collect())
    assert got == [("1", "und", False), ("2", "und", False), ("3", "und", False), ("4", "en", True), ("4", "en", True), ("5", "en", True), ("None", "de", True)]
    assert language_id.predict(docs([]), model).count() == 0
    assert language_id.train(docs(rows)) is None  # no labels
    assert {r.lang_pred for r in language_id.predict(docs(odd), None).collect()} == {"und"}


def test_pair_tables_equal_plain_convolution():
    model = language_id.ByteCnn(["a", "b"]).start(3)
    x, text, size = language_id.as_windows([b"hello", b"", b"z" * 300])
    assert list(text) == [0, 1, 2, 2] and list(size) == [5, 1, 256, 44]
    plain = np.concatenate([r.max(axis=1) for r in model.responses(x.astype(np.int64))], axis=1)
    assert np.allclose(model.pooled(x, model.pair_tables()), plain, atol=1e-5)


def test_same_table_same_model(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    a, b = language_id.train(df), language_id.train(df.repartition(7))
    assert all(np.array_equal(p, q) for p, q in zip(a.kernels, b.kernels, strict=True))


def test_a_false_alarm_rate_is_estimated():
    rng = np.random.default_rng(2)
    good = rng.random(4000) < 0.8
    votes = np.where(good[:, None], np.where(rng.random((4000, 4)) < [0.2, 0.01, 0.01, 0.01], -1, 1), np.where(rng.random((4000, 4)) < 0.7, -1, 1))
    found, counts = np.unique(weak_quality.pattern_of(votes), return_counts=True)
    model = weak_quality.LabelModel.fit(found, counts, 4, prior=0.0)
    assert np.abs(model.chance[1, :, 0] - [0.2, 0.01, 0.01, 0.01]).max() < 0.03 and np.abs(model.chance[0, :, 0] - 0.7).max() < 0.06
    strict = weak_quality.LabelModel.fit(found, counts, 4, prior=1.0)
    assert 0.001 < strict.chance[1, 0, 0] < model.chance[1, 0, 0]


def test_fitted_rows_are_whole_and_bounded(spark):
    rows = [(i % 50, f"text {i % 50} " + "word " * 400, "en") for i in range(300)]  # each row six times
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.sample(df, "doc_id", "text", "lang", 20)
    assert len(got) == 20 and all(len(t) > 2000 for _, t in got)
    assert language_id.sample(df.limit(0), "doc_id", "text", "lang", 20) == [] and len(language_id.sample(df, "doc_id", "text", "lang", 1000)) == 300


def test_quality_by_a_plain_version(spark, docs):
    """Posterior and score of each text by itself, summed label by label and feature by feature."""
    rows = [(i, "Some plain words of prose stand here, and more of them follow. " * (1 + i % 5) if i % 4 else "%%% ### %%% ### $$$ " * (2 + i % 3)) for i in range(60)] + [(100, None), (101, ""), (102, " \n"), (5, "twice twice twice twice"), (5, "twice twice twice twice")]
    model = weak_quality.train(docs(rows))
    got = sorted((r.row.doc_id, r.n_words, round(r.posterior, 9), round(r.score, 9)) for r in weak_quality.score(docs(rows), model).collect())
    want = []
    for k, t in rows:
        if not (t or "").split():
            want.append((k, 0, 0.0, 0.0))
            continue
        one = weak_quality.Texts([t.encode()])
        odds = np.log(model.labels.prior / (1 - model.labels.prior))
        for j, v in enumerate(one.votes()[0]):
            odds += np.log(model.labels.chance[1, j, v + 1]) - np.log(model.labels.chance[0, j, v + 1])
        z = model.bias + sum(model.weights[f] for pair in one.features() for f in pair) / (len(t.split()) + weak_quality.SMOOTH)
        want.append((k, len(t.split()), round(float(1 / (1 + np.exp(-odds))), 9), round(float(1 / (1 + np.exp(-z))), 9)))
    assert got == sorted(want)
    assert weak_quality.score(docs([]), model).count() == 0


def test_languages_by_a_plain_version(spark, docs):
    """Each window of each text by itself, filter by filter."""
    rows = [(i, ("und die anderen schönen Wörter der Sprache" if i % 2 else "the words of the other language and more") + f" {i}") for i in range(80)]
    df = docs(rows).selectExpr("doc_id", "text", "CASE WHEN doc_id % 2 = 1 THEN 'de' ELSE 'en' END AS lang")
    model = language_id.train(df)
    texts = [(1, "der schöne Tag " * 60), (2, "one"), (3, None), (4, "42 !"), (5, ""), (6, "the end"), (6, "the end"), (7, "ä" * 300)]
    got = sorted((r.row.doc_id, r.lang_pred, round(r.score, 4)) for r in language_id.predict(docs(texts), model).collect())
    want = []
    for k, t in texts:
        if not any(c.isalpha() for c in t or ""):
            want.append((k, "und", 0.0))
            continue
        raw, z = t.encode(), np.zeros(2)
        for at in range(0, len(raw), 256):
            piece = raw[at : at + 256]
            window, best = piece.ljust(256, b"\0"), []
            for w, kernel in zip(model.widths, model.kernels, strict=True):
                best += np.max([sum(kernel[j][window[i + j]] for j in range(w)) for i in range(256 - w + 1)], axis=0).tolist()
            z += (np.maximum(np.array(best) + model.bias, 0) @ model.out + model.out_bias) * len(piece)
        p = np.exp(z / len(raw) - (z / len(raw)).max())
        want.append((k, model.languages[int(p.argmax())], round(float((p / p.sum()).max()), 4)))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in sorted(want)] and np.allclose([c for *_, c in got], [c for *_, c in sorted(want)], atol=1e-3)


def test_quality_against_labels(spark, duck):
    got = {r.doc_id: r for r in queries.op6_quality(spark, DATA).collect()}
    told = duck.sql("select doc_id, quality from labels").fetchall()
    good, bad = ([got[k].keep for k, q in told if q == v] for v in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    right = (0.95, 0.85, 0.7, 0.9)
    votes = np.stack([np.where(rng.random(len(truth)) < 0.3, 0, np.where((rng.random(len(truth)) < r) == truth, 1, -1)) for r in right], axis=1)
    patterns, counts = np.unique(weak_quality.pattern_of(votes), return_counts=True)
    model = weak_quality.LabelModel.fit(patterns, counts, 4, prior=0.0)
    assert np.allclose(list(model.accuracy().values()), right, atol=0.03) and abs(model.prior - 0.8) < 0.03
    assert np.array_equal(weak_quality.votes_of(weak_quality.pattern_of(votes), 4), votes)


def test_quality_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x"), (4, "x"), (None, "A sentence of words, and more. " * 9), (5, "!!! ### $$$ " * 50), (6, "word " * 100_000)]
    df = docs(rows, votes="a", score="b", posterior="c", row="d")
    model = weak_quality.train(df)
    got = {str(r.row.doc_id): r for r in weak_quality.score(df, model).collect()}
    assert [got[k].score for k in "123"] == [0, 0, 0] and got["6"].n_words == 100_000 and len(got["5"].votes) == len(weak_quality.LABELLERS)
    assert weak_quality.score(docs([]), weak_quality.train(docs([]))).count() == 0
