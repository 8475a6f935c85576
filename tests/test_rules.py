"""The rules, on literals."""

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text as t
from pageloom.functions import titles
from pageloom.operators import documents, forms, grouping, legacy, signals
from pageloom.sources import files, sinks
from pageloom.streaming import incremental


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def arr(*xs):
    return F.array(*[F.lit(x) for x in xs]).cast("array<string>")


# --- text


@pytest.mark.parametrize("raw", ["", "a", " a ", "\t\n a  ", "\x1c\x1fa b\x85", "   "])
def test_strip(spark, raw):
    assert value(spark, t.strip(F.lit(raw))) == raw.strip()


@pytest.mark.parametrize("raw", ["", "a\nb", "a\r\nb\rc", "a\x0b\x0cb\x1cc\x1dd\x1ee\x85f g h", " \n a \n\n"])
def test_lines(spark, raw):
    assert value(spark, t.lines(F.lit(raw))) == [x.strip() for x in raw.splitlines() if x.strip()]


@pytest.mark.parametrize("raw", ["O'NEIL 2ND", "ab cd", "ÉTÉ d'ici", "1a", ""])
def test_title_case(spark, raw):
    assert value(spark, t.title_case(F.lit(raw))) == raw.title()
    assert value(spark, t.is_upper(F.lit(raw))) == raw.isupper()


@pytest.mark.parametrize("raw,want", [("ST-556 State Tax", "ST-556_State_Tax"), ("Form: A/B", "Form_AB"), ("!!!", "Untitled"), (" Hello ", "Hello"), ("Título ñ", "Título_ñ")])
def test_sanitize_title(spark, raw, want):
    assert value(spark, t.sanitize_title(F.lit(raw))) == want


def test_file_names(spark):
    assert value(spark, t.sanitize_filename(F.lit(' a<b>:"/\\|?*  c\t'))) == "ab c"
    assert value(spark, t.sanitize_filename(F.lit("??"))) == "Untitled"
    assert value(spark, t.output_name(F.lit("x/source.pdf"), "json")) == "source.json"
    assert value(spark, t.blob_target(F.lit("a/x.pdf"), F.lit("p.pdf"))) == "x/p.pdf"
    assert value(spark, titles.fallback_name(F.lit(3), F.lit(5))) == "pages_3-5"
    assert value(spark, titles.fallback_name(F.lit(3), F.lit(3))) == "page_3"


# --- titles

BODY = ["body text line here"] * 3


@pytest.mark.parametrize(
    "lines,last,want",
    [
        ([*BODY, "FEDERAL DISCLOSURE REQUIREMENTS", *BODY, "RETAIL INSTALLMENT CONTRACT", *["body content line here"] * 2, "FOR USED VEHICLES ONLY", *BODY, *BODY], True, "RETAIL INSTALLMENT CONTRACT"),
        (["1200 EXAMPLE LN 99999ZZSAMPLE TOWN"], False, None),
        (["DT 5/23", "APPLICABLE LAW"], False, None),
        (["SAMPLEMAN MOTORS TRUCK VAN LLC"], False, None),
        (["DIVULGACIÓN DE LA TASA MAXIMA DEL 36"], False, None),
        (["ODOMETER DISCLOSURE STATEMENT", "WARNING ODOMETER DISCREPENCY"], False, "ODOMETER DISCLOSURE STATEMENT"),
        (["FEDERAL TRUTH IN LENDING DISCLOSURES", "RETAIL INSTALLMENT CONTRACT"], True, "RETAIL INSTALLMENT CONTRACT"),
        (["RouteOne®", "Credit Application", "[X] You are applying for individual credit"], False, "Credit Application"),
        (["RouteOne®", "Title Last Name First", "Date of Birth Info", "Home Address Line", "Some Field Label", "Another Row Label", "Credit Application"], False, "Title Last Name First"),
        (["Title Last Name First Middle Suffix"], False, None),
        (["Make Trim VIN"], False, None),
        ([], False, None),
    ],
)
def test_text_title(spark, lines, last, want):
    assert value(spark, titles.text_title(arr(*lines), last)) == want


# --- signals


@pytest.mark.parametrize(
    "text,want",
    [
        ("DOCUMENT 1 OF 2\nApplicable Law\nsome content here to exceed fifty chars minimum threshold", ("NEW_DOC", "Applicable Law", 1, None)),
        ("Retail Purchase Agreement\nsome body content here\nPage 1 of 3", ("NEW_DOC", "Retail Purchase Agreement", 1, 3)),
        ("continued body content on page two here\nPage 2 of 3", ("CONTINUATION", None, 2, 3)),
        ("LAW 553-IL-ARB-ea 8/22 v1    Page 5 of 6\nArbitration provision content follows here", ("CONTINUATION", None, 5, 6)),
        ("FORM NO. LAWIL-RATECAP (Rev. 8/22)\nThe information on this form is part of your contract.\nDISCLOSURE OF 36% RATE CAP\nFurther content of the disclosure form goes here.", ("NEW_DOC", "DISCLOSURE OF 36% RATE CAP", None, None)),
        ("DT 5/23\nsome form content without any page numbering markers here", ("AMBIGUOUS", None, None, None)),
        ("DT 6/17\nINCOMPLETE APPLICATIONS WILL NOT BE PROCESSED\nx", ("NEW_DOC", "Credit Application", None, None)),
        ("Some Heading Here\nPage 1 of 1", ("NEW_DOC", "Some Heading Here", 1, None)),
        ("Page 0 of 3\nPage 99999999999999 of 3", ("CONTINUATION", None, 2**31 - 1, 3)),
        ("", ("AMBIGUOUS", None, None, None)),
    ],
)
def test_text_page(spark, text, want):
    assert tuple(value(spark, signals.text_page_signal(F.lit(text), t.lines(F.lit(text))))) == want


OCR = "array<struct<box:array<struct<x:double,y:double>>,text:string,confidence:double>>"


def ocr(*lines):
    return F.array(*[F.struct(F.array(*[F.struct(F.lit(0.0).alias("x"), F.lit(float(y)).alias("y")) for y in (0, 0, h, h)]).alias("box"), F.lit(x).alias("text"), F.lit(0.9).alias("confidence")) for x, h in lines]).cast(OCR)


@pytest.mark.parametrize(
    "seen,bottom,top,want",
    [
        (True, [("Page 3 of 6", 30)], [("Some Title", 30)], ("CONTINUATION", None, 3, 6)),
        (True, [], [("ST-556 State Tax", 30)], ("NEW_DOC", "ST-556 State Tax", None, None)),
        (True, [], [("x" * 61, 30)], ("AMBIGUOUS", None, None, None)),
        (False, [], [], ("AMBIGUOUS", None, None, None)),
        (True, [("Page 1 of 6", 30)], [("Title Here", 30)], ("NEW_DOC", "Title Here", 1, 6)),
        (True, [("Page 1 of 4", 30)], [], ("NEW_DOC", None, 1, 4)),
        (True, [("Page 1 of 1", 30)], [], ("AMBIGUOUS", None, None, None)),
        (True, [], [("First Title", 30), ("Second Title", 30)], ("NEW_DOC", "First Title", None, None)),
        (True, [], [("Invoice", 160)], ("AMBIGUOUS", None, None, None)),
    ],
)
def test_image_page(spark, seen, bottom, top, want):
    assert tuple(value(spark, signals.image_page_signal(F.lit(seen), ocr(*bottom), ocr(*top)))) == want


def test_flat_ocr(spark):
    assert value(spark, signals.flat_ocr(ocr(("ST-556 State Tax", 1), ("Transaction Return", 1)))) == ["ST-556 State Tax", "Transaction Return"]
    assert value(spark, signals.flat_ocr(F.lit(None).cast(OCR))) == []
    assert value(spark, signals.flat_ocr(F.array(F.lit(None)).cast(OCR))) == []


def test_routing_and_stages(spark):
    pages = spark.createDataFrame([("a", 0, "x" * 50), ("a", 1, " x "), ("a", 2, None)], "pdf_id string, page_idx int, text string")
    digital, images = signals.route(pages)
    assert [r.page_idx for r in digital.collect()] == [0] and images.count() == 2
    read = lambda df, strip: df.withColumn(strip, F.when((F.col("page_idx") == 1) & F.lit(strip == "bottom"), ocr(("Page 2 of 3", 9))).otherwise(ocr(("Some Title", 30))))
    tops = {r.page_idx: r.top for r in signals.ocr_stages(images, read).collect()}
    assert tops[1] is None and tops[2] is not None


# --- grouping

NAMES = {"N": "NEW_DOC", "C": "CONTINUATION", "A": "AMBIGUOUS"}


@pytest.mark.parametrize(
    "given,want",
    [
        ("N", [[0]]), ("N C C", [[0, 1, 2]]), ("N N", [[0], [1]]), ("N A A", [[0, 1, 2]]), ("A N", [[0, 1]]), ("C N", [[0], [1]]), ("N/3 C/3 C/3 C/4 C/4 C/4", [[0, 1, 2], [3, 4, 5]]),
        ("N/3 C/3 C/3", [[0, 1, 2]]), ("N N N", [[0], [1], [2]]), ("A A N", [[0, 1, 2]]), ("N A N", [[0, 1], [2]]), ("N/3 A C/4", [[0, 1, 2]]), ("N/3 C/4", [[0], [1]]), ("A C/2 N", [[0, 1], [2]]), ("N C/4 C/5", [[0, 1], [2]]),
    ],
)
def test_groups(spark, given, want):
    rows = [("p", i, NAMES[s[0]], None, int(s[2:]) if "/" in s else None) for i, s in enumerate(given.split())]
    df = spark.createDataFrame(rows, "pdf_id string, page_idx int, classification string, title_text string, total_pages_in_doc int")
    assert [r.page_idxs for r in grouping.summarise(grouping.with_groups(df)).orderBy("group_no").collect()] == want


def test_manifest(spark):
    rows = [("p", 0, "NEW_DOC", "Form ABC", None), ("p", 1, "NEW_DOC", "Form ABC", None), ("p", 2, "NEW_DOC", None, None), ("p", 3, "AMBIGUOUS", None, None), ("q", 2, "NEW_DOC", "", None)]
    df = spark.createDataFrame(rows, "pdf_id string, page_idx int, classification string, title_text string, total_pages_in_doc int")
    assert [r.file_name for r in grouping.manifest(df).orderBy("pdf_id", "group_no").collect()] == ["Form_ABC.pdf", "Form_ABC (2).pdf", "pages_3-4.pdf", "page_3.pdf"]
    assert grouping.manifest(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "texts,want",
    [
        (["cover", "DOCUMENT 1 OF 2\nA TITLE", "x", "DOCUMENT 2 OF 2\nB"], [(1, 3, "A Title.pdf"), (3, 4, "B.pdf")]),
        (["x", "Page 1 of 2", "Page 2 of 2"], [(0, 1, "x.pdf"), (1, 3, "Page 1 of 2.pdf")]),
        (["x", "Page1of3"], [(0, 1, "x.pdf"), (1, 2, "Page1of3.pdf")]),
        (["", None], []),
        (["DOCUMENT 1 OF 2", "DOCUMENT 2 OF 2\nPage 3"], [(0, 1, "Document 1.pdf"), (1, 2, "Document 2.pdf")]),
    ],
)
def test_legacy(spark, texts, want):
    df = spark.createDataFrame([("p", i, x) for i, x in enumerate(texts)], "pdf_id string, page_idx int, text string")
    found = legacy.segments(df)
    assert [(r.start_page, r.end_page, r.file_name) for r in found.orderBy("start_page").collect()] == want
    if not want:
        with pytest.raises(ValueError):
            legacy.require_segments(found)


# --- documents


def test_documents(spark):
    df = spark.createDataFrame([("d", 1, "Page 2"), ("d", 0, "Page 1"), ("d", 2, ""), ("e", 0, None)], "pdf_id string, page_idx int, text string")
    got = {r.pdf_id: r for r in documents.documents(df).collect()}
    assert (got["d"].combined_text, got["d"].all_text, got["d"].page_count, got["e"].combined_text) == ("Page 1\n\nPage 2", "Page 1\nPage 2\n", 3, "")
    meta = spark.createDataFrame([("d", {"/Title": "Example", "Author": None})], "pdf_id string, metadata map<string,string>")
    n = {r.source_path: r for r in documents.nested(df, meta).collect()}
    assert n["d"].metadata == {"Title": "Example", "Author": None} and n["d"].pages[0].page_number == 1 and not n["e"].metadata


# --- forms


@pytest.mark.parametrize("text,want", [("Credit Application: Applicant\nMr. Doe John 01/01/1980", ("Doe", "John")), ("credit application:Applicant\nDrake John", ("ake", "John")), ("Credit Application: Applicant\nDoe", (None, None)), ("none", (None, None))])
def test_routeone_name(spark, text, want):
    assert tuple(value(spark, F.struct(*[c.alias(n) for c, n in zip(forms.routeone_name(F.lit(text)), "ab", strict=True)]))) == want


def test_routeone(spark):
    assert value(spark, forms.routeone_phones(F.lit("at the following telephone number(s): 312-555-0100, 3125550100; 555-0101."))) == ["312-555-0100"]
    assert value(spark, forms.routeone_phones(F.lit("at the following telephone number(s): 847.882.8400."))) == []
    assert value(spark, forms.routeone_consent(F.lit("Optional Consent x\nApplicant: By Date 13/45/2024 Source: R1"))) == "opted_in"
    assert value(spark, forms.routeone_consent(F.lit("Optional Consent x Applicant: By Date Source: 1/2/2024"))) == "opted_out"
    assert value(spark, forms.routeone_consent(F.lit("nothing"))) == "opted_out"


def test_dealertrack(spark):
    assert tuple(value(spark, F.struct(*[c.alias(n) for c, n in zip(forms.dealertrack_name(F.lit("x\nDOE JANE 000-00-0000\ny")), "ab", strict=True)]))) == ("DOE", "JANE")
    fused = "312-555-0100 312-555-0101"
    assert value(spark, forms.dealertrack_phones(F.lit(f"at the following number(s) {fused} including any cell phone numbers"))) == [fused]
    assert value(spark, forms.form_type(F.lit("routeone and DT 6"))) == "routeone"


def test_extract_and_sheet(spark):
    rows = [("a.pdf", "scan", False, None), ("b.pdf", "DT 5\nDOE JANE 000-00-0000", True, 0), ("c.pdf", "DT 5", True, None)]
    df = spark.createDataFrame(rows, "source_file string, text string, text_heavy boolean, checkbox_page int")
    vision = spark.createDataFrame([("b.pdf", '{"opt_in_status": "opted_in"}')], "source_file string, answer string")
    got = {r.source_file: (r.form_type, r.opt_in_status, r.confidence, r.last_name) for r in forms.extract(df, vision).collect()}
    assert got == {"a.pdf": ("unknown", "unclear", "low", None), "b.pdf": ("dealertrack", "opted_in", "medium", "DOE"), "c.pdf": ("dealertrack", "not_found", "low", None)}
    assert {r.source_file: r.page for r in forms.needs_vision(df).collect()} == {"a.pdf": None, "b.pdf": 0}
    one = spark.range(1).select(F.struct(F.lit(None).cast("string").alias("last_name"), F.lit(None).cast("string").alias("first_name"), arr("1").alias("telemarketing_phones"), F.lit("opted_in").alias("opt_in_status"), F.lit("s").alias("source_file")).alias("r")).select("r.*")
    assert tuple(forms.sheet(one).first()) == ("", "", "1", "", "", "opted_in", "s")
    bad = spark.range(1).select(forms.error_record(F.lit("z.pdf")).alias("r")).select("r.*")
    assert tuple(forms.sheet(bad).first()) == ("", "", "", "", "", "error", "z.pdf")


# --- sources, sinks, streams


def test_discovery(spark, tmp_path):
    (tmp_path / "nested").mkdir()
    for name in ("top.pdf", "Odd.PDF", "x.txt", "nested/nested.pdf"):
        (tmp_path / name).write_bytes(b"%PDF")
    names = lambda df: [r.path.rsplit("/", 1)[1] for r in df.collect()]
    assert names(files.discover(spark, str(tmp_path))) == ["top.pdf"]
    assert sorted(names(files.discover(spark, str(tmp_path), recursive=True))) == ["nested.pdf", "top.pdf"]
    assert names(files.discover(spark, str(tmp_path / "Odd.PDF"))) == ["Odd.PDF"]
    assert [r.name for r in files.list_blobs(spark, str(tmp_path)).collect()] == ["Odd.PDF", "nested.pdf", "top.pdf"]
    with pytest.raises(ValueError):
        files.discover(spark, str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path / "none"))


def test_pages_and_sinks(spark, tmp_path):
    content = spark.createDataFrame([("a/x.pdf", bytearray(b"one\x0ctwo ")), ("b/x.pdf", bytearray(b""))], "path string, content binary")
    pages = files.read_pages(content, lambda c: enumerate(c.decode().split("\x0c")))
    assert sorted((r.pdf_id, r.page_number, r.text, r.n_chars) for r in pages.collect()) == [("a/x.pdf", 1, "one", 3), ("a/x.pdf", 2, "two", 3), ("b/x.pdf", 1, "", 0)]
    nested = documents.nested(pages)
    for kind, ending in (("text", "txt"), ("json", "json")):
        made = sinks.write_documents(nested, str(tmp_path / kind), kind).orderBy("source_path").collect()
        assert [(r.source_path, r.file_name) for r in made] == [("a/x.pdf", f"x.{ending}"), ("b/x.pdf", f"x (2).{ending}")]
        assert all(open(r.written).read() == "one\n\ntwo" * (r.source_path == "a/x.pdf") for r in made if kind == "text")
    empty = forms.sheet(forms.extract(spark.createDataFrame([], "source_file string, text string, text_heavy boolean, checkbox_page int")))
    assert sinks.write_sheet(empty, str(tmp_path / "sheet")) == 0 and not (tmp_path / "sheet").exists()


def test_write_splits(spark, tmp_path):
    made = spark.createDataFrame([("p", 1, "A.pdf", [0, 1])], "pdf_id string, group_no int, file_name string, page_idxs array<int>")
    contents = spark.createDataFrame([("p", bytearray(b"xyz"))], "pdf_id string, content binary")
    got = sinks.write_splits(made, contents, lambda pdf, name, content, pages: f"{pdf}/{name}:{len(content)}:{pages}", str(tmp_path)).first()
    assert got.written == "p/A.pdf:3:[0, 1]"


def test_stream(spark, tmp_path):
    spark.createDataFrame([("p", 0, "DOCUMENT 1 OF 1\nA TITLE"), ("p", 1, "more")], "pdf_id string, page_idx int, text string").write.parquet(str(tmp_path / "in"))
    query = incremental.split_stream(incremental.watch_pages(spark, str(tmp_path / "in"), "pdf_id string, page_idx int, text string"), lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / f"out{n}")), str(tmp_path / "state"))
    query.awaitTermination()
    assert [r.file_name for r in spark.read.parquet(str(tmp_path / "out0")).collect()] == ["A_Title.pdf"]


@pytest.mark.parametrize(
    ("lines", "marker", "want"),
    [(["Page 1", "page 2", "Page 3", "Page 4", "DOCUMENT 1 OF 2", "Late line"], -1, "Late line"), (["a b", *["Page 1"] * 9], 0, "a b"), (["x", "DOCUMENT 1 OF 2", *["Page 1"] * 5, "after"], 1, "after"), (["Page 1"] * 6, -1, "none")],
)
def test_marker_titles_far_from_the_marker(spark, lines, marker, want):
    from pageloom.functions.titles import marker_title

    assert value(spark, marker_title(arr(*lines), F.lit(marker), F.lit("none"))) == want
