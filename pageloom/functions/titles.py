"""Titles of pages from their lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as p
from .text import digit_count, first_that, has_word, is_upper, once, sanitize_filename, title_case, without_stars


def is_meaningful(line: Column) -> Column:
    """Not empty, a bare page number, a document marker or the watermark."""
    return (line != "") & ~(F.lower(line).startswith("page") & line.rlike(p.BARE_PAGE)) & ~is_marked(line) & ~F.lower(line).startswith(p.WATERMARK)


def is_marked(text: Column) -> Column:
    """Whether a line or a text has a document marker."""
    return has_word(text, "document") & text.rlike(p.DOC_MARKER)


def marker_index(lines: Column) -> Column:
    """Of the first line with a document marker, from 0; -1 if none has."""
    found = F.transform(lines, is_marked)
    return (F.array_position(found, F.lit(True)) - 1).cast("int")


def marker_title(lines: Column, marker: Column, fallback: Column) -> Column:
    """The first meaningful line after the marker's, else the first of all, else the fallback as it is."""
    after = once(marker, lambda k: first_that(F.slice(lines, k + 2, F.greatest(F.size(lines), F.lit(1))), is_meaningful))
    name = lambda x: sanitize_filename(F.when(is_upper(x), title_case(x)).otherwise(x))
    return once(F.coalesce(after, first_that(lines, is_meaningful)), lambda x: F.when(x.isNotNull(), name(x)).otherwise(fallback))


def _could_be(s: Column, least: int, most: int) -> Column:
    """What either pass asks of a line: length, no sentence, ASCII, no label, address or number, so many words."""
    return (
        F.length(s).between(p.TITLE_MIN_CHARS, p.TITLE_MAX_CHARS)
        & ~s.endswith(".")
        & ~s.rlike(r"[^\x00-\x7F]")
        & s.rlike(rf"^{p.NOT_WS}+(?:{p.WS}+{p.NOT_WS}+){{{least - 1},{most - 1}}}$")
        & ~s.rlike(rf"^\d+(?:{p.WS}|$)")
        & s.rlike(rf"[A-Za-z](?:(?:(?!{p.WS})[^A-Za-z])*[A-Za-z]){{2}}")
        & (digit_count(s) < 7)
        & ~s.rlike(p.TITLE_SKIP)
        & ~s.rlike(p.SECTION_HEADER)
        & ~s.rlike(p.DOC_MARKER)
    )


def text_title(lines: Column, prefer_last: bool = False) -> Column:
    """A line of capitals in the first half (ten lines at least), the first or the last of them; else a line of two to
    four capitalised words among the first six; else null."""
    half = F.greatest(F.floor(F.size(lines) / 2), F.lit(10)).cast("int")
    head = F.transform(F.slice(lines, F.lit(1), half), without_stars)
    capitals = F.filter(head, lambda s: (s == F.upper(s)) & s.rlike("[A-Za-z]") & _could_be(s, 3, 8))
    chosen = F.try_element_at(capitals, F.lit(-1 if prefer_last else 1))
    named = F.filter(
        F.transform(F.slice(lines, 1, 6), without_stars),
        lambda s: (s != F.upper(s)) & ~s.rlike(rf"(?:^|{p.WS})[a-z]") & ~s.rlike(rf"(?:^|{p.WS})(?:(?:(?!{p.WS})[^a-z])*[A-Z]){{3}}(?:(?!{p.WS})[^a-z])*(?:{p.WS}|$)") & _could_be(s, 2, 4),
    )
    return once(F.coalesce(chosen, F.get(named, F.lit(0))), lambda title: F.when(title.isNotNull(), sanitize_filename(title)))


def content_title(text: Column) -> Column:
    """The title of a form that prints none."""
    return F.when(has_word(text, "incomplete") & text.rlike(p.DT_FOOTER) & text.rlike(p.INCOMPLETE_NOTICE), F.lit(p.CREDIT_APPLICATION))


def fallback_name(first: Column, last: Column) -> Column:
    """From page numbers counted from 1."""
    return F.when(last > first, F.format_string("pages_%d-%d", first, last)).otherwise(F.format_string("page_%d", first))


def numbered(base: Column, n: Column, extension: str = ".pdf") -> Column:
    """base (n), for the second of a name and later ones."""
    return F.concat(base, F.when(n > 1, F.format_string(" (%d)", n)).otherwise(F.lit("")), F.lit(extension))
