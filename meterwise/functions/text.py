"""Tokenising text.

``split`` takes a regular expression and keeps empty tokens, so a double blank,
an empty line and a trailing blank all yield the empty word (D10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The separators of the reference word count.
WORD_SEPARATOR = " "
LINE_SEPARATOR = "\r\n|\r|\n"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col: str | Column, pattern: str = WORD_SEPARATOR) -> Column:
    """``split(col, pattern)`` as an array column."""
    return F.split(_c(col), pattern)


def explode_words(df: DataFrame, col: str = "value", out: str = "word",
                  pattern: str = WORD_SEPARATOR, drop_empty: bool = False) -> DataFrame:
    """One row per token of ``col`` (X7 + X8). Other columns are not kept."""
    words = df.select(F.explode(tokens(col, pattern)).alias(out))
    if drop_empty:
        words = words.filter(F.col(out) != "")
    return words


def explode_lines(df: DataFrame, col: str, out: str = "value") -> DataFrame:
    """Split a multi-line text column into one row per line, like ``read.text``."""
    return df.select(F.explode(F.split(_c(col), LINE_SEPARATOR)).alias(out))
