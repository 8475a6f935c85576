"""Greedy wrapping of text into lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrap(text: Column, width: int) -> Column:
    """The text's lines of at most so many characters; a longer word has a line of its own.  One pass over the text: each
    line is the longest run of words that fits, or else one word."""
    words = F.array_join(F.filter(F.split(text, " "), lambda w: w != ""), " ")
    fits = f"[^ ](?:.{{0,{width - 2}}}[^ ])?" if width > 1 else "[^ ]"
    return F.regexp_extract_all(words, F.lit(f"(?s)({fits}|[^ ]+)(?: |$)"), F.lit(1))
