"""Consumption questions: filters, grouped totals and means, tariff contrast.

Covers F1-F3, F5, F7, A1-A9, A11. Every aggregate is a built-in hash aggregate,
planned as partial (map side) + final, so a hot key such as one social group
holding a third of all rows is pre-reduced in each task before the shuffle: the
shuffle carries one row per key per task, never the raw rows.
Every output column is aliased explicitly (D5).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.functions.calendar import month_text
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD, TARIFF, TARIFF_FLAT, TARIFF_WARNED, TIME


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _round(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def exact_sum(col: str | Column, scale: int) -> Column:
    """Sum as a decimal of ``scale`` places, then back to double: independent of row order.

    A reading with more decimal places is an error, never rounded.
    """
    c = F.col(col) if isinstance(col, str) else col
    exact = c.cast(T.DecimalType(28, scale))
    fits = c.isNull() | (exact.cast("double") == c.cast("double"))
    return F.sum(F.when(fits, exact).otherwise(F.raise_error(
        F.format_string(f"%s has more than {scale} decimal places", c.cast("string"))))).cast("double")


#: Bits in a part of a reproducible sum; three parts reach 90 bits below the largest value.
PART_BITS, PARTS = 30, 3


def top_exponent(df: DataFrame, col: str) -> int:
    """The power of two above every finite value of a column (one pruned pass)."""
    c = F.abs(F.col(col).cast("double"))
    top = df.agg(F.max(F.when(c < float("inf"), c))).first()[0]
    return math.frexp(top)[1] if top else 0


def reproducible_sum(col: str | Column, exponent: int) -> Column:
    """A sum of doubles that doesn't depend on row order or partitions, bit by bit.

    Every value is cut on one grid, below 2^``exponent``, into integers of ``PART_BITS`` bits; integers are
    summed exactly and put together in one order. What is below the grid, 90 bits under the
    largest value, is rounded row by row. Infinities and NaN add up as usual.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    finite = F.abs(c) < float("inf")
    rest, sums = F.when(finite, c), []
    for i in range(1, PARTS + 1):
        unit = math.ldexp(1.0, max(exponent - PART_BITS * i, -1000))
        part = F.rint(rest / F.lit(unit))
        sums.append(F.sum(part.cast("decimal(20,0)")).cast("double") * F.lit(unit))
        rest = rest - part * F.lit(unit)
    wild = F.sum(F.when(~finite, c))
    return F.when(wild.isNotNull(), wild).otherwise(sums[2] + sums[1] + sums[0])


def reproducible_by(df: DataFrame, keys: str | Sequence[str], value: str = ENERGY) -> DataFrame:
    """Sum and mean per group (A2-A8), equal under any partitioning: ``total``, ``avg``, ``n``."""
    total, n = reproducible_sum(value, top_exponent(df, value)), F.count(value)
    return df.groupBy(*_keys(keys)).agg(total.alias("total"), (total / n).alias("avg"), n.alias("n"))


# ---- filters ---------------------------------------------------------------

def filter_text(df: DataFrame, predicate: str) -> DataFrame:
    """SQL-text predicate, ``df.filter('x > 1')`` (F1)."""
    return df.filter(predicate)


def above(df: DataFrame, threshold: float, col: str = ENERGY) -> DataFrame:
    """Column predicate ``df[col] > threshold`` (F2)."""
    return df.filter(F.col(col) > F.lit(threshold))


def above_in_group(df: DataFrame, threshold: float, group: str,
                   col: str = ENERGY, group_col: str = GROUP) -> DataFrame:
    """Conjunction ``(df[col] > t) & (df[group_col] == group)``."""
    return df.filter((F.col(col) > F.lit(threshold)) & (F.col(group_col) == F.lit(group)))


def equal_to(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter, e.g. tariff ``== 'ToU'``."""
    return df.filter(F.col(col) == F.lit(value))


def in_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Closed range ``low <= col <= high``."""
    return df.filter(F.col(col).between(low, high))


# ---- aggregates ------------------------------------------------------------

def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """``count()`` as a one-row frame (A1)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: str | Sequence[str], value: str = ENERGY,
            name: str = "avg", digits: int | None = None) -> DataFrame:
    """``groupBy(keys).agg(avg(value))``."""
    return df.groupBy(*_keys(keys)).agg(_round(F.avg(value), digits).alias(name))


def sum_by(df: DataFrame, keys: str | Sequence[str], value: str = ENERGY,
           name: str = "total", exact_scale: int | None = None) -> DataFrame:
    """``groupBy(keys).agg(sum(value))`` (A4, A6); decimal sum if ``exact_scale``."""
    agg = exact_sum(value, exact_scale) if exact_scale is not None else F.sum(value)
    return df.groupBy(*_keys(keys)).agg(agg.alias(name))


def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "count") -> DataFrame:
    """``groupBy(keys).count()``."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def numeric_means_by(df: DataFrame, keys: str | Sequence[str],
                     digits: int | None = None) -> DataFrame:
    """The no-argument ``groupBy(k).mean()``: every numeric non-key column (A2).

    Output names are ``avg_<column>`` instead of ``avg(<column>)`` (D5).
    """
    ks = _keys(keys)
    numeric = [f.name for f in df.schema.fields
               if f.name not in ks and isinstance(f.dataType, T.NumericType)]
    return df.groupBy(*ks).agg(*[_round(F.avg(c), digits).alias(f"avg_{c}") for c in numeric])


def numeric_sums_by(df: DataFrame, keys: str | Sequence[str],
                    exact_scale: int | None = None) -> DataFrame:
    """The no-argument ``groupBy(k).sum()`` (A4), named ``sum_<column>``."""
    ks = _keys(keys)
    numeric = [f.name for f in df.schema.fields
               if f.name not in ks and isinstance(f.dataType, T.NumericType)]
    aggs = [(exact_sum(c, exact_scale) if exact_scale is not None else F.sum(c)).alias(f"sum_{c}")
            for c in numeric]
    return df.groupBy(*ks).agg(*aggs)


def grand_total(df: DataFrame, value: str = ENERGY, exact_scale: int | None = None) -> DataFrame:
    """Global ``agg({value: 'sum'})`` plus the row count (A5 + A1)."""
    total = exact_sum(value, exact_scale) if exact_scale is not None else F.sum(value)
    return df.agg(total.alias("total_kwh"), F.count(F.lit(1)).alias("n_rows"))


def monthly_mean(df: DataFrame, by: str = GROUP, value: str = ENERGY, ts: str = TIME,
                 name: str = "avg", digits: int | None = None) -> DataFrame:
    """Mean per (month key, ``by``), ordered by the month key as text (A3, O5, §3.2)."""
    # Group on integer (year, month) and format the text key only on the
    # aggregated rows: no per-row string building in the scan stage.
    return (_by_month_parts(df, ts, F.col(by), F.col(value))
              .groupBy("_year", "_month", by)
              .agg(_round(F.avg(value), digits).alias(name))
              .select(month_text("_year", "_month").alias("Month"), by, name)
              .orderBy("Month"))


def _by_month_parts(df: DataFrame, ts: str, *cols: Column) -> DataFrame:
    t = F.col(ts)
    return df.select(F.year(t).alias("_year"), F.month(t).alias("_month"), *cols)


def tariff_contrast(df: DataFrame, by_month: bool = True, value: str = ENERGY,
                    tariff: str = TARIFF, warned: str = TARIFF_WARNED,
                    flat: str = TARIFF_FLAT, ts: str = TIME,
                    digits: int | None = None) -> DataFrame:
    """Is the warned tariff group's mean use below the flat group's (A11)?

    One pass: conditional averages inside a single aggregate, no self-join.
    """
    v, t = F.col(value), F.col(tariff)
    warned_avg = F.avg(F.when(t == warned, v))
    flat_avg = F.avg(F.when(t == flat, v))
    aggs = [_round(warned_avg, digits).alias("avg_warned"),
            _round(flat_avg, digits).alias("avg_flat"),
            _round(warned_avg - flat_avg, digits).alias("diff"),
            (warned_avg < flat_avg).alias("warned_below")]
    if by_month:
        names = ["avg_warned", "avg_flat", "diff", "warned_below"]
        return (_by_month_parts(df, ts, v, t)
                  .groupBy("_year", "_month").agg(*aggs)
                  .select(month_text("_year", "_month").alias("Month"), *names)
                  .orderBy("Month"))
    return df.agg(*aggs)


def contrast_errors(df: DataFrame, value: str = ENERGY, household: str = HOUSEHOLD, tariff: str = TARIFF,
                    warned: str = TARIFF_WARNED, flat: str = TARIFF_FLAT, ts: str = TIME) -> DataFrame:
    """Is the contrast of :func:`tariff_contrast` real (A11)? Per month: ``diff``, ``std_err``, ``t_value``, ``n_households``.

    Readings of one household are alike, so the variance of the difference is clustered by household: with a household's
    sum s and count n in a tariff group of mean m and N readings, its part is (s - n m) / N, warned minus flat,
    and the variance the sum of squared parts. Two aggregates: by household and month, then by month.
    """
    known = df.filter(F.col(value).isNotNull() & F.col(household).isNotNull())
    v = F.col(value).cast("double")
    parts = []
    for side, kind in (("w", warned), ("f", flat)):
        mine = F.col(tariff) == kind
        parts += [F.coalesce(F.sum(F.when(mine, v)), F.lit(0.0)).alias(f"s{side}"), F.count(F.when(mine, v)).cast("double").alias(f"n{side}")]
    each = (_by_month_parts(known, ts, F.col(household), F.col(tariff), F.col(value)).filter(F.col(tariff).isin(warned, flat))
            .groupBy("_year", "_month", household).agg(*parts))
    names = ["sw", "nw", "sf", "nf"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = each.groupBy("_year", "_month").agg(*(F.sum(c).alias(c) for c in names), F.count(F.lit(1)).alias("n_households"),
                                               *(F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a, b in pairs))
    mw, mf = F.try_divide("sw", "nw"), F.try_divide("sf", "nf")

    def spread(s, n, m):
        return (F.col(s + s) - 2 * m * F.col(s + n) + m * m * F.col(n + n)) / (F.col(n) * F.col(n))

    both = (F.col("swsf") - mf * F.col("swnf") - mw * F.col("nwsf") + mw * mf * F.col("nwnf")) / (F.col("nw") * F.col("nf"))
    variance = F.when((F.col("nw") > 0) & (F.col("nf") > 0), F.greatest(spread("sw", "nw", mw) + spread("sf", "nf", mf) - 2 * both, F.lit(0.0)))
    return (sums.select(month_text("_year", "_month").alias("Month"), (mw - mf).alias("diff"), F.sqrt(variance).alias("std_err"), "n_households")
            .select("Month", "diff", "std_err", F.try_divide("diff", "std_err").alias("t_value"), "n_households"))


# ---- ordering --------------------------------------------------------------

#: Groups of tasks that merge their first rows before the last task does.
TOP_BUCKETS = 256


def _first_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    # The rank filter becomes a group limit on both sides of the shuffle, so a task sends k rows.
    best = Window.partitionBy("_bucket").orderBy(*order)
    return (df.withColumn("_bucket", F.spark_partition_id() % TOP_BUCKETS).withColumn("_rank", F.row_number().over(best))
            .filter(F.col("_rank") <= k).drop("_bucket", "_rank").orderBy(*order).limit(k))


def top_k(df: DataFrame, k: int, by: str = ENERGY,
          tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Largest ``k`` rows by ``by`` (O1, O6), ties broken deterministically.

    Two levels: each task keeps its own top ``k``, ``TOP_BUCKETS`` groups of tasks merge theirs,
    and the last task reads at most ``k`` rows of each group, whatever the number of tasks.
    Without explicit tie breakers every other column breaks ties, which makes
    the returned rows unique up to fully identical rows.
    """
    rest = list(tie_breakers) if tie_breakers is not None else [c for c in df.columns if c != by]
    return _first_rows(df, [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in rest], k)


def bottom_k(df: DataFrame, k: int, by: str = ENERGY,
             tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Smallest ``k`` rows, nulls first as in ``orderBy(col)`` (O2, D3)."""
    rest = list(tie_breakers) if tie_breakers is not None else [c for c in df.columns if c != by]
    return _first_rows(df, [F.col(by).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in rest], k)


def sort_desc(df: DataFrame, col: str) -> DataFrame:
    """``sort(col, ascending=False)``."""
    return df.sort(F.col(col).desc())
