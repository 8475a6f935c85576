"""Whole jobs, with stand-ins for PDFs (texts parted by form feeds), OCR and vision."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from pageloom import __main__ as cli
from pageloom.functions.text import stem_of
from pageloom.functions.wrap import wrap
from pageloom.operators import grouping, legacy, signals
from pageloom.plans import jobs
from pageloom.sources import backends, files, objects, ocr, sinks, synthetic, vision


def parse(content):
    if content.startswith(b"broken"):
        raise ValueError("not a PDF")
    return list(enumerate(content.decode().split("\x0c")))


LONG = "some content here to exceed the fifty characters that a page needs"
PDF = f"DOCUMENT 1 OF 2\nApplicable Law\n{LONG}\x0cmore of it, {LONG}\x0cDT 6/17\nINCOMPLETE APPLICATIONS WILL NOT BE PROCESSED\n{LONG}\x0cDT 6/18\nINCOMPLETE APPLICATIONS WILL NOT BE PROCESSED\n{LONG}"
RO = f"RouteOne\nCredit Application: Applicant\nDoe John 1\nat the following telephone number(s): 312-555-0100. {LONG}"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.pdf").write_text(PDF)
    (tmp_path / "in" / "sub" / "b.pdf").write_text("one\x0ctwo")
    for name, text in (("x", RO), ("y", "broken"), ("z", "scan")):
        (tmp_path / "forms" / name).mkdir(parents=True)
        (tmp_path / "forms" / name / "Credit_Application.pdf").write_text(text)
    (tmp_path / "forms" / "Credit_Application (2).pdf").write_text(RO)
    return tmp_path


def test_extract(spark, folder, capsys):
    out = str(folder / "out")
    assert cli.main([str(folder / "in"), "--output-dir", out, "--recursive"], parse) == 0
    assert capsys.readouterr().out.split() == [f"{out}/a.txt", f"{out}/b.txt"]
    assert (folder / "out" / "b.txt").read_text() == "one\n\ntwo"
    (folder / "in" / "sub" / "a.pdf").write_text("caf\u00e9")
    made = jobs.extract(spark, str(folder / "in"), out, "json", True, parse).orderBy("source_path").collect()
    assert [r.file_name for r in made] == ["a.json", "a (2).json", "b.json"]  # none replaces another
    text = (folder / "out" / "a (2).json").read_text()
    assert text.startswith('{\n  "source_path": "file:') and '\n  "page_count": 1,\n' in text and "caf\\u00e9" in text and json.loads(text)["pages"] == [{"page_number": 1, "text": "caf\u00e9"}]
    with pytest.raises(ValueError):
        jobs.extract(spark, str(folder), out, parse=parse)


def test_split(spark, folder, capsys):
    out = str(folder / "out")

    def cut(pdf, name, content, pages):
        return objects.put(f"{out}/{stem_of(pdf)}", name, str(pages).encode())

    assert cli.main([str(folder / "in" / "a.pdf"), "--split-documents", "--split-output-dir", out], parse, cut) == 0
    assert capsys.readouterr().out.splitlines() == ["[1] -> Applicable_Law.pdf", "[2] -> Credit_Application.pdf", "[3] -> Credit_Application (2).pdf"]
    (folder / "in" / "c.pdf").write_text(PDF)
    assert cli.main(["*", "--split-documents", "--store", str(folder / "in"), "--split-output-dir", out], parse, cut) == 0
    said = capsys.readouterr().out.splitlines()
    assert said[:6] == ["[1] -> a/Applicable_Law.pdf", "[2] -> a/Credit_Application.pdf", "[3] -> a/Credit_Application (2).pdf", "[4] -> b/pages_1-2.pdf", "[5] -> c/Applicable_Law.pdf", "[6] -> c/Credit_Application.pdf"] or said
    assert "Opt-in results (2 record(s))" in said[-1] and said[-1].endswith(".xlsx")
    for pdf in "ac":  # documents of one name in two PDFs both stay
        assert (folder / "out" / pdf / "Credit_Application.pdf").read_text() == "[2]"


def test_split_records_and_markers(spark, folder):
    path = str(folder / "in" / "a.pdf")
    got = jobs.split_records(spark, path, parse).collect()
    assert [(r.source_file, r.form_type, r.opt_in_status) for r in got] == [("a/Credit_Application.pdf", "dealertrack", "not_found")]
    made = jobs.split_by_markers(spark, path, lambda pdf, name, content, pages: f"{name}:{pages}", parse, str(folder / "out"))
    assert [r.written for r in made.collect()] == ["Applicable Law.pdf:[0, 1, 2, 3]"]


@pytest.mark.parametrize("argv", [["{f}/none"], ["{f}/in/sub/../../forms/x/none.pdf"], ["{f}/in", "--store", "x"], ["{f}/forms", "--split-documents", "--recursive"], ["*", "--split-documents", "--store", "{f}/empty"], ["{f}", "--format", "xml"]])
def test_bad_input_ends_with_status_2(spark, folder, argv):
    (folder / "empty").mkdir()
    with pytest.raises(SystemExit) as e:
        cli.main([a.replace("{f}", str(folder)) for a in argv], parse)
    assert e.value.code == 2


def test_forms_to_sheet(spark, folder):
    out = str(folder / "sheet")
    assert jobs.forms_to_sheet(spark, str(folder / "forms"), out, parse) == 3
    rows = [tuple(x or "" for x in r)[:6] for r in spark.read.option("header", "true").csv(out).orderBy(F.input_file_name()).collect()]
    assert rows == [("Doe", "John", "312-555-0100", "", "", "opted_out"), ("", "", "", "", "", "error"), ("", "", "", "", "", "unclear")]
    assert jobs.forms_to_sheet(spark, str(folder / "in"), str(folder / "none"), parse) == 0 and not (folder / "none").exists()
    assert jobs.result_name("20260102_030405") == "opt_in_results_20260102_030405"


def test_ocr(spark):
    df = spark.createDataFrame([("p", 0, bytearray(b"a")), ("p", 1, bytearray(b"b")), ("p", 2, None)], "pdf_id string, page_idx int, raster binary")
    box = [(0, 0), (9, 0), (9, 30), (0, 30)]
    made = lambda: lambda raster, strip: {(b"a", "bottom"): [(box, "Page 2 of 3", 0.9)], (b"b", "top"): [(box, "Bill of Sale", 0.8)]}.get((raster, strip), [])
    out = signals.ocr_stages(df, lambda pages, strip: ocr.read_strips(pages, strip, made)).select("page_idx", signals.image_page_signal(F.col("raster").isNotNull(), F.col("bottom"), F.col("top")).alias("s"))
    assert {r.page_idx: (r.s.classification, r.s.title_text) for r in out.collect()} == {0: ("CONTINUATION", None), 1: ("NEW_DOC", "Bill of Sale"), 2: ("AMBIGUOUS", None)}
    rows = spark.range(1).select(*ocr.strip_rows(F.lit(1000), "top"), *ocr.strip_rows(F.lit(1000), "bottom"), ocr.raster_scale(F.lit(750))).first()
    assert tuple(rows) == (0, 250, 850, 1000, 2.0)


def test_vision(spark):
    requests = spark.createDataFrame([("a", None, "routeone"), ("b", 3, "dealertrack"), ("c", None, "unknown")], "source_file string, page int, kind string")
    asked = vision.with_prompt(requests, F.col("kind"))
    assert {r.source_file: (r.prompt, r.dpi) for r in asked.collect()} == {"a": ("routeone", 150), "b": ("checkbox", 300), "c": ("dealertrack", 150)}
    contents = spark.createDataFrame([(k, bytearray(k.encode())) for k in "abc"], "source_file string, content binary")

    def client():
        def ask(prompt, content, page, dpi):
            if content == b"c":
                raise RuntimeError("refused")
            return f'{{"opt_in_status": "{page} {dpi}"}}'

        return ask

    assert {r.source_file: (r.answer, r.error) for r in vision.answers(asked, contents, client).collect()} == {"a": ('{"opt_in_status": "None 150"}', None), "b": ('{"opt_in_status": "3 300"}', None), "c": (None, "refused")}


def test_workbook(tmp_path):
    place = f"{tmp_path}/x.xlsx"
    assert sinks.write_workbook(["Last Name", "Consent"], iter([("O'Neil & <Co>", ""), ("\x07ü", "opted_in")]), place) == 2
    with zipfile.ZipFile(place) as z:
        sheet, book = z.read("xl/worksheets/sheet1.xml").decode(), z.read("xl/workbook.xml").decode()
    assert 'name="Opt-In Results"' in book and '<c r="A1" t="inlineStr" s="1"><is><t xml:space="preserve">Last Name</t>' in sheet
    assert "O'Neil &amp; &lt;Co&gt;" in sheet and ">ü<" in sheet and sheet.count("<row ") == 3


def test_scanned_pages_are_split_by_ocr(spark, tmp_path):
    (tmp_path / "s.pdf").write_text("1\x0c2\x0c3")
    box = [(0, 0), (9, 0), (9, 30), (0, 30)]

    def reader():
        said = {("0", "top"): "Bill of Sale", ("1", "bottom"): "Page 2 of 2", ("2", "top"): "Odometer Statement"}
        return lambda raster, strip: [(box, said[raster.decode(), strip], 0.9)] if (raster.decode(), strip) in said else []

    read = jobs.ocr_reader(reader, lambda content, i: str(i).encode())
    made = jobs.split(spark, f"{tmp_path}/s.pdf", lambda pdf, name, content, pages: str(pages), parse, read, f"{tmp_path}/out").orderBy("group_no").collect()
    assert [(r.file_name, r.written) for r in made] == [("Bill_of_Sale.pdf", "[0, 1]"), ("Odometer_Statement.pdf", "[2]")]


def test_vision_client(monkeypatch):
    monkeypatch.delenv("AZURE_OPENAI_ENDPOINT", raising=False)
    with pytest.raises(OSError):
        backends.vision_client()()
    monkeypatch.setenv("AZURE_OPENAI_ENDPOINT", "e")
    monkeypatch.setenv("AZURE_OPENAI_API_KEY", "k")
    seen = []

    class Opened:
        def __init__(self, said):
            self.said, self.chat, self.completions, self.choices, self.message = said, self, self, [self], self

        def create(self, **asked):
            seen.append(asked)
            return self

        @property
        def content(self):
            return self.said

    ask = backends.vision_client(draw=lambda content, page, dpi: b"png" if page else None, open_client=lambda e, k: Opened('{"a": 1}'))()
    assert ask("p", b"", 0, 150) == "{}" and not seen  # a page without an image is not asked about
    assert ask("p", b"", 2, 150) == '{"a": 1}'
    assert seen[0]["model"] == "gpt-4o" and seen[0]["max_tokens"] == 512 and seen[0]["messages"][0]["content"][0]["image_url"]["url"] == "data:image/png;base64,cG5n"
    assert backends.vision_client("d", lambda *a: b"x", lambda e, k: Opened("no JSON"))()("p", b"", 1, 150) == "{}" and seen[1]["model"] == "d"


def test_store_settings(monkeypatch):
    monkeypatch.delenv("AZURE_STORAGE_CONNECTION_STRING", raising=False)
    with pytest.raises(OSError):
        files.options_from_connection_string()
    assert files.options_from_connection_string("AccountName=n;AccountKey=a==;EndpointSuffix=x") == {"spark.hadoop.fs.azure.account.key.n.dfs.core.windows.net": "a=="}


def test_discovery_lists_one_folder(spark, folder):
    (folder / "in" / "B.PDF").write_text("x")
    (folder / "in" / "[odd] .pdf").write_text("x")
    names = lambda *a: [r.path.rsplit("/", 1)[-1] for r in files.discover(spark, *a).collect()]
    assert len(names(str(folder / "in"))) == 2 and len(names(str(folder / "in"), True)) == 3 and names(str(folder / "in" / "B.PDF")) == ["B.PDF"]
    assert len(names(str(folder / "in" / "[odd] .pdf"))) == 1 and names(str(folder)) == []


def test_public_names():
    import pageloom

    assert all(callable(getattr(pageloom, n)) for n in pageloom.__all__)


def test_made_up_stream(spark):
    pages = synthetic.five_documents(spark)
    assert pages.where("page_idx = 0").first().text.startswith("Package")
    assert [r.file_name for r in legacy.segments(pages).orderBy("start_page").collect()] == [f"{t}.pdf" for t in synthetic.TITLES]
    made = grouping.manifest(signals.with_text_signals(pages)).orderBy("group_no").collect()
    assert [r.file_name for r in made] == [f"{t.replace(' ', '_')}.pdf" for t in synthetic.TITLES] and made[0].start_page == 1


@pytest.mark.parametrize("text,want", [("", []), ("a b  c", ["a b c"]), ("aaaa bbbb cc", ["aaaa", "bbbb cc"]), ("longer-than-it x", ["longer-than-it", "x"])])
def test_wrap(spark, text, want):
    assert spark.range(1).select(wrap(F.lit(text), 7).alias("x")).first().x == want
