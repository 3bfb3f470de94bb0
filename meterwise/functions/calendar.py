"""Calendar columns (X1-X6) and the month key.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.schemas import TIME


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_key(ts: str | Column) -> Column:
    """Unpadded ``year-month`` text, e.g. ``2012-9``.

    Same text as ``date_format(ts, 'y-M')`` for years 1000-9999, but built from
    ``year``/``month`` so it never depends on the session time zone (D15).
    Sorted as text, ``2012-10`` comes before ``2012-9`` (D4); order charts by
    :func:`month_start` instead.
    """
    ts = _c(ts)
    return month_text(F.year(ts), F.month(ts))


def month_text(year: str | Column, month: str | Column) -> Column:
    """``year-month`` text from integer parts; null when either part is null."""
    year, month = _c(year), _c(month)
    return F.when(year.isNotNull() & month.isNotNull(), F.concat_ws("-", year, month))


def month_key_formatted(ts: str | Column) -> Column:
    """The reference spelling of X4: ``date_format(ts, 'y-M')``."""
    return F.date_format(_c(ts), "y-M")


def month_start(ts: str | Column) -> Column:
    """First day of the month as a ``date``: the sortable month key."""
    return F.trunc(F.to_date(_c(ts)), "month")


def to_day(ts: str | Column) -> Column:
    """``cast(ts as date)``."""
    return F.to_date(_c(ts))


def with_calendar(df: DataFrame, ts: str = TIME, prefix: str = "") -> DataFrame:
    """Append month, day, hour, year, day of year, ISO week, month key and month start.

    The text key is ``month_key`` here: Spark column names are case-insensitive,
    so ``Month`` would clash with ``month``.
    """
    t = F.col(ts)
    return df.select(
        "*",
        F.month(t).alias(f"{prefix}month"),
        F.dayofmonth(t).alias(f"{prefix}day"),
        F.hour(t).alias(f"{prefix}hour"),
        F.year(t).alias(f"{prefix}year"),
        F.dayofyear(t).alias(f"{prefix}day_of_year"),
        F.weekofyear(t).alias(f"{prefix}week_of_year"),
        month_key(t).alias(f"{prefix}month_key"),
        month_start(t).alias(f"{prefix}month_start"),
    )


def with_month(df: DataFrame, ts: str = TIME, name: str = "Month") -> DataFrame:
    """``withColumn('Month', date_format(ts, 'y-M'))`` (P1 + X4)."""
    return df.withColumn(name, month_key(ts))


def formatted_number(col: str | Column, digits: int = 2) -> Column:
    """``format_number`` (X6): grouped thousands, fixed decimals, as text."""
    return F.format_number(_c(col), digits)
