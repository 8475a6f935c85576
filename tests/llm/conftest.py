import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a table of documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows, parts=3, **more):
        names = list(more)
        full = [(k, x, None, "s", None if x is None else len(x), *[more[n] for n in names]) for k, x in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", {n} string" for n in names)).repartition(parts)

    return make
