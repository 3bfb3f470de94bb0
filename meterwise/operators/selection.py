"""Rank selection: which row stands at a position, without sorting or moving the table.

The row at position ``k`` of a lexicographic order is found column by column. In each column the
range of values that holds the rank is narrowed: a few of its distinct values are drawn by the least of
several hashes, the rows up to each are counted, and the one range with the rank
goes on. Every step is a filtered, pruned scan with a one-row aggregate; rows never shuffle.
A split at the position is then a pair of plain filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct values drawn to narrow a range: each round leaves about a 16th of it.
SPLITTERS = 32


def _is(name: str, value) -> Column:
    return F.col(f"`{name}`").isNull() if value is None else F.col(f"`{name}`").eqNullSafe(F.lit(value))


def _below(name: str, value) -> Column:
    """Whether the column comes before ``value`` (ascending, nulls first); never null."""
    if value is None:
        return F.lit(False)
    return F.col(f"`{name}`").isNull() | (F.col(f"`{name}`") < F.lit(value))


def _value_at(df: DataFrame, name: str, k: int):
    """(value, rows before it, rows with it) of the ``k``-th smallest value of one column."""
    c = F.col(f"`{name}`")
    nulls = df.filter(c.isNull()).count()
    if k < nulls:
        return None, 0, nulls
    low, before = None, nulls  # rows up to and with `low` come before the range
    high = None
    while True:
        inside = df.filter(c.isNotNull())
        if low is not None:
            inside = inside.filter(c > F.lit(low))
        if high is not None:
            inside = inside.filter(c <= F.lit(high))
        drawn = inside.agg(F.max(c).alias("top"), *(F.min_by(c, F.xxhash64(c, F.lit(i))).alias(f"s{i}") for i in range(SPLITTERS))).first()
        splits = sorted(set(drawn))
        counts = inside.agg(*(F.count(F.when(c <= F.lit(s), 1)).alias(f"n{i}") for i, s in enumerate(splits)),
                            *(F.count(F.when(c == F.lit(s), 1)).alias(f"e{i}") for i, s in enumerate(splits))).first()
        at = next(i for i in range(len(splits)) if k < before + counts[f"n{i}"])
        upto, equal = before + counts[f"n{at}"], counts[f"e{at}"]
        if k >= upto - equal:
            return splits[at], upto - equal, equal
        high = splits[at]
        if at:
            low, before = splits[at - 1], before + counts[f"n{at - 1}"]


class Cut:
    """The key at a position: fixed columns and values, rows before it, and rows equal to it."""

    def __init__(self, key: list[tuple[str, object]], before: int, equal: int):
        self.key, self.before, self.equal = key, before, equal

    def precedes(self) -> Column:
        """Rows before the key; never null."""
        out = F.lit(False)
        for name, value in reversed(self.key):
            out = _below(name, value) | (_is(name, value) & out)
        return out

    def equals(self) -> Column:
        return reduce(Column.__and__, (_is(name, value) for name, value in self.key))


def select_at(df: DataFrame, order: Sequence[str], k: int) -> Cut:
    """The key of the row at position ``k`` (from 0) in ``order``, ascending, nulls first.

    Columns not in ``order`` break ties, so rows equal to a whole key are equal rows. Columns must be
    of a type that can be ordered. Stops at the first prefix of columns that only one row has.
    """
    key, before, equal, rest = [], 0, None, df
    for name in [*order, *(c for c in df.columns if c not in order)]:
        value, less, equal = _value_at(rest, name, k - before)
        key.append((name, value))
        before += less
        rest = rest.filter(_is(name, value))
        if equal == 1:
            break
    return Cut(key, before, equal)


def positional_flag(df: DataFrame, order: Sequence[str], fraction: float, name: str) -> DataFrame:
    """``df`` with a boolean column: whether a row is among the first ``fraction`` in ``order``.

    A filterless projection of ``df`` unless the cut falls among equal rows: then these are
    dealt out as so many copies on each side.
    """
    n = df.count()
    k = int(n * fraction)
    if k <= 0 or k >= n:
        return df.withColumn(name, F.lit(k > 0))
    cut = select_at(df, order, k)
    first = k - cut.before
    if not first:
        return df.withColumn(name, cut.precedes())
    one = df.filter(cut.equals()).first()
    copies = [F.lit(one[c]).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    ties = df.sparkSession.range(cut.equal).select(*copies, (F.col("id") < first).alias(name))
    return df.filter(~cut.equals()).withColumn(name, cut.precedes()).unionByName(ties)


def positional_split(df: DataFrame, order: Sequence[str], fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First ``fraction`` of the rows in ``order`` vs the rest (M11, pandas ``iloc``)."""
    flagged = positional_flag(df, order, fraction, "_first")
    return flagged.filter("_first").drop("_first"), flagged.filter("NOT _first").drop("_first")
