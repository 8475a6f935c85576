"""Fields of credit applications, and the sheet of consent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.text import digits, strip, words

VISION = "struct<last_name:string,first_name:string,opt_in_status:string,telemarketing_phones:array<string>,confidence:string>"
SHEET = ("Last Name", "First Name", "Phone 1", "Phone 2", "Phone 3", "Consent", "Source File")
_NO_PHONES = "array<string>"


def form_type(text: Column) -> Column:
    return F.when(text.rlike(p.ROUTEONE), F.lit("routeone")).when(text.rlike(p.DT_FOOTER), F.lit("dealertrack")).otherwise(F.lit("unknown"))


def unique_phones(raw: Column) -> Column:
    """Numbers of ten digits or more, the first of each by its digits, stripped, in order."""
    keys = F.transform(raw, digits)
    kept = F.filter(raw, lambda x, i: (F.length(digits(x)) >= 10) & (F.array_position(keys, digits(x)) == i + 1))
    return F.transform(kept, strip)


def routeone_name(text: Column) -> tuple[Column, Column]:
    """Last and first name: the first two words of the applicant's line, behind a title; null without both."""
    line = F.regexp_replace(strip(F.regexp_extract(text, p.RO_APPLICANT, 1)), p.RO_PERSON_TITLE, "")
    parts = words(line)
    both = F.size(parts) >= 2
    return F.when(both, F.get(parts, F.lit(0))), F.when(both, F.get(parts, F.lit(1)))


def routeone_phones(text: Column) -> Column:
    found = F.regexp_extract(text, p.RO_PHONES, 1)
    return F.when(text.rlike(p.RO_PHONES), unique_phones(F.transform(F.split(found, "[,;]"), strip))).otherwise(F.array().cast(_NO_PHONES))


def routeone_consent(text: Column) -> Column:
    return F.when(F.regexp_extract(text, p.RO_CONSENT, 1).rlike(p.DATE_SEEN), F.lit("opted_in")).otherwise(F.lit("opted_out"))


def dealertrack_name(text: Column) -> tuple[Column, Column]:
    """From the line whose third word has the form of a social security number, which is not read."""
    return F.nullif(F.regexp_extract(text, p.DT_NAME, 1), F.lit("")), F.nullif(F.regexp_extract(text, p.DT_NAME, 2), F.lit(""))


def dealertrack_phones(text: Column) -> Column:
    return unique_phones(F.regexp_extract_all(F.regexp_extract(text, p.DT_PHONES, 1), F.lit(f"({p.PHONE_LIKE})"), F.lit(1)))


def parse_vision(answer: Column) -> Column:
    """A vision model's JSON; what can't be read is an empty answer."""
    return F.from_json(answer, VISION)


def extract(forms: DataFrame, vision: DataFrame | None = None) -> DataFrame:
    """form_type .. confidence and source_file of each form.

    forms: source_file, text (all pages'), text_heavy, checkbox_page (of the first page with the checkbox, or null).
    vision: source_file, answer (JSON); at most one row a file.  A form that would need an answer and has none is
    unclear.  Forms that say all in their text need none.
    """
    seen = forms.withColumn("_v", F.lit(None).cast(VISION)) if vision is None else forms.join(vision.select("source_file", parse_vision(F.col("answer")).alias("_v")), "source_file", "left")
    text, v, heavy, kind = F.col("text"), F.col("_v"), F.col("text_heavy"), F.col("_kind")
    ro, dt = (kind == "routeone") & heavy, (kind == "dealertrack") & heavy
    has_box = F.col("checkbox_page").isNotNull()

    def pick(of_ro: Column, of_dt: Column, of_vision: Column) -> Column:
        return F.when(ro, of_ro).when(dt, of_dt).otherwise(of_vision)

    (ro_last, ro_first), (dt_last, dt_first) = routeone_name(text), dealertrack_name(text)
    none = F.array().cast(_NO_PHONES)
    return seen.withColumn("_kind", form_type(text)).select(
        kind.alias("form_type"), pick(ro_last, dt_last, v["last_name"]).alias("last_name"), pick(ro_first, dt_first, v["first_name"]).alias("first_name"),
        pick(routeone_consent(text), F.when(has_box, F.coalesce(v["opt_in_status"], F.lit("unclear"))).otherwise("not_found"), F.coalesce(v["opt_in_status"], F.lit("unclear"))).alias("opt_in_status"),
        pick(routeone_phones(text), dealertrack_phones(text), F.coalesce(v["telemarketing_phones"], none)).alias("telemarketing_phones"),
        pick(F.lit("high"), F.when(has_box, F.coalesce(v["confidence"], F.lit("medium"))).otherwise("low"), F.coalesce(v["confidence"], F.lit("low"))).alias("confidence"), "source_file",
    )


def needs_vision(forms: DataFrame) -> DataFrame:
    """Forms that a vision model must see, with the one page for it (null: all): to be filtered before any rendering."""
    kind, heavy = form_type(F.col("text")), F.col("text_heavy")
    whole = (kind == "unknown") | ~heavy
    return forms.where(whole | ((kind == "dealertrack") & F.col("checkbox_page").isNotNull())).withColumn("page", F.when(~whole, F.col("checkbox_page")))


def error_record(source: Column) -> Column:
    """What stands for a form that could not be read."""
    none = F.lit(None).cast("string")
    return F.struct(none.alias("form_type"), none.alias("last_name"), none.alias("first_name"), F.lit("error").alias("opt_in_status"), F.array().cast(_NO_PHONES).alias("telemarketing_phones"), none.alias("confidence"), source.alias("source_file"))


def credit_applications(documents: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Documents of exactly the name of a credit application; numbered ones are not."""
    return documents.where(F.col(name_col) == p.CREDIT_APPLICATION_FILE)


def sheet(records: DataFrame) -> DataFrame:
    """Seven texts for each record: three phones, empty where there is nothing."""
    empty, phones = F.lit(""), F.col("telemarketing_phones")
    cells = [F.col("last_name"), F.col("first_name"), *[F.get(phones, F.lit(i)) for i in range(3)], F.col("opt_in_status"), F.col("source_file")]
    return records.select(*[F.coalesce(c, empty).alias(n) for c, n in zip(cells, SHEET, strict=True)])
