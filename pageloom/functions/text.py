"""Scalar text functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import LINE_ENDS, NOT_IN_FILE_NAMES, WS


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is evaluated once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_that(xs: Column, fits: Callable[[Column], Column], near: int = 4) -> Column:
    """The first of xs that fits; null if none does.  A few are tried before all of them."""
    return F.coalesce(F.get(F.filter(F.slice(xs, 1, near), fits), F.lit(0)), F.get(F.filter(xs, fits), F.lit(0)))


def has_word(c: Column, word: str) -> Column:
    """Whether c holds a word of small ASCII letters in any case: what patterns that begin with it need, at less cost."""
    return F.contains(F.lower(c), F.lit(word))


def strip(c: Column) -> Column:
    """Without white space, of any kind Unicode has, at both ends.  Where both ends are visible ASCII, nothing is searched."""
    visible = lambda x, at: F.substring(x, at, 1).between("!", "~")
    return once(c, lambda x: F.when(visible(x, 1) & visible(x, -1), x).otherwise(F.regexp_replace(x, f"^{WS}+|{WS}+$", "")))


def lines(c: Column) -> Column:
    """The stripped, non-empty lines."""
    return F.filter(F.transform(F.split(c, LINE_ENDS), strip), lambda x: x != "")


def words(c: Column) -> Column:
    """What white space separates; none in an empty text."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def digit_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{Nd}", ""))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\P{Nd}", "")


def is_upper(c: Column) -> Column:
    """A cased letter at least, and none in lower case."""
    return (c == F.upper(c)) & (c != F.lower(c))


def title_case(c: Column) -> Column:
    """A capital after whatever is not a letter, small letters else."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))), "")


def or_untitled(c: Column) -> Column:
    return once(c, lambda x: F.when(x != "", x).otherwise(F.lit("Untitled")))


def sanitize_filename(c: Column) -> Column:
    """Without characters that file names can't have; runs of white space are one space."""
    return or_untitled(F.regexp_replace(strip(F.regexp_replace(c, NOT_IN_FILE_NAMES, "")), f"{WS}+", " "))


def sanitize_title(c: Column) -> Column:
    """Word characters and hyphens only, joined by underscores."""
    kept = strip(F.regexp_replace(c, r"(?U)[^\w\s\x1c-\x1f-]", ""))
    return or_untitled(F.regexp_replace(F.regexp_replace(kept, f"{WS}+", "_"), "^_+|_+$", ""))


def without_stars(c: Column) -> Column:
    return strip(once(c, lambda x: F.when(F.contains(x, F.lit("*")), F.regexp_replace(x, r"\*+$", "")).otherwise(x)))


def stem(path: Column) -> Column:
    """The last part of a path without its extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def output_name(path: Column, kind: str) -> Column:
    return F.concat(stem(path), F.lit("." + {"text": "txt", "json": "json"}[kind]))


def blob_target(source: Column, name: Column) -> Column:
    return F.concat_ws("/", stem(source), name)


def stem_of(path: str) -> str:
    """stem() of a path that is known."""
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] else name
