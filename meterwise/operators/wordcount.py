"""Word count.

``lines -> split(' ') -> explode -> groupBy(word).count() -> sort desc``, all
built-in expressions. The count is a partial + final hash aggregate: a word that
makes up a third of the corpus (the empty word, "the") is summed inside every
task first, so the shuffle moves one row per distinct word per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions.text import WORD_SEPARATOR, explode_lines, explode_words


def word_count(lines: DataFrame, col: str = "value", pattern: str = WORD_SEPARATOR,
               drop_empty: bool = False, ordered: bool = True) -> DataFrame:
    """``word string, count bigint`` for a one-line-per-row frame."""
    counts = (explode_words(lines, col, "word", pattern, drop_empty)
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    # The word breaks ties: most distinct words share a count of 1, and a sort on
    # the count alone would range-partition all of them into one task.
    return counts.sort(F.col("count").desc(), F.col("word").asc()) if ordered else counts


def word_count_of_texts(docs: DataFrame, col: str = "text", drop_empty: bool = False,
                        ordered: bool = True) -> DataFrame:
    """Word count of multi-line text cells: lines first, as ``read.text`` would."""
    return word_count(explode_lines(docs, col), "value", WORD_SEPARATOR, drop_empty, ordered)


def word_count_rdd(lines_rdd):
    """The RDD spelling (S9, X9, A10), kept only as a parity check for tests.

    ``reduceByKey`` combines map-side like the DataFrame partial aggregate.
    """
    return (lines_rdd.flatMap(lambda line: line.split(WORD_SEPARATOR))
                     .map(lambda w: (w, 1))
                     .reduceByKey(lambda a, b: a + b))


def pair_text(word_col: str = "word", count_col: str = "count") -> F.Column:
    """Text of a ``(word, count)`` pair as ``saveAsTextFile`` prints it (K6).

    Python's repr quotes with ``'`` unless the word holds ``'`` and no ``"``.
    """
    w = F.col(word_col)
    # After the backslash: tab, line feed, carriage return by letter, other controls by number.
    named = {9: "\\t", 10: "\\n", 13: "\\r"}
    plain = F.replace(w, F.lit("\\"), F.lit("\\\\"))
    for code in (*range(32), *range(127, 161), 173):
        plain = F.replace(plain, F.lit(chr(code)), F.lit(named.get(code, f"\\x{code:02x}")))
    escaped = F.replace(plain, F.lit("'"), F.lit("\\'"))
    dq = w.contains("'") & ~w.contains('"')
    body = F.when(dq, F.concat(F.lit('"'), plain, F.lit('"'))) \
            .otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))
    return F.concat(F.lit("("), body, F.lit(", "), F.col(count_col).cast("string"), F.lit(")"))
