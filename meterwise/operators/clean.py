"""Cleaning: null rules, header lines, positional names and casts.

Covers F4, F6, F8-F12 and P4-P7, P9. Null dropping is spelled as ``IS NOT NULL``
predicates rather than ``na.drop`` so that the conditions reach the Parquet scan
as pushed filters (``na.drop`` plans an ``AtLeastNNonNulls`` filter that is not
pushed); the meaning is the same, NaN counting as missing like ``na.drop``.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text the source files use for a missing cell.
NULL_MARKER = "Null"


def _present(df: DataFrame, name: str) -> Column:
    """True when the cell counts as present for ``na.drop`` (not null, not NaN)."""
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def drop_incomplete(df: DataFrame, how: str = "any", thresh: int | None = None,
                    subset: Sequence[str] | None = None) -> DataFrame:
    """Same rows as ``df.na.drop(how, thresh, subset)``.

    * ``how="any"``: keep rows where every column in ``subset`` is present.
    * ``how="all"``: keep rows where at least one is present.
    * ``thresh=n``: keep rows with at least ``n`` present cells (overrides ``how``).
    """
    cols = list(subset) if subset else df.columns
    present = [_present(df, c) for c in cols]
    if thresh is not None:
        n_present = reduce(lambda a, b: a + b, [p.cast("int") for p in present])
        return df.filter(n_present >= F.lit(thresh))
    if how == "any":
        return df.filter(reduce(lambda a, b: a & b, present))
    if how == "all":
        return df.filter(reduce(lambda a, b: a | b, present))
    raise ValueError(f"how must be 'any' or 'all', not {how!r}")


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is null."""
    return df.where(F.col(col).isNull())


def replace_marker(df: DataFrame, marker: str = NULL_MARKER,
                   subset: Iterable[str] | None = None) -> DataFrame:
    """Turn a literal missing-value marker in string columns into null."""
    names = set(subset) if subset is not None else None
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType) and (names is None or field.name in names):
            c = F.when(c == marker, F.lit(None).cast("string")).otherwise(c).alias(field.name)
        out.append(c)
    return df.select(*out)


def drop_marked(df: DataFrame, marker: str = NULL_MARKER) -> DataFrame:
    """F12 end to end: marker to null in any column, then drop incomplete rows."""
    return drop_incomplete(replace_marker(df, marker))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give ``_c0, _c1, ...`` their real names by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def drop_header_rows(df: DataFrame, col: str, header_value: str | None = None) -> DataFrame:
    """Drop header lines that arrived as data.

    ``!=`` also drops rows whose ``col`` is null, as the reference filter does.
    """
    return df.filter(F.col(col) != F.lit(header_value if header_value is not None else col))


def cast_to_schema(df: DataFrame, schema: T.StructType, lenient: bool = True) -> DataFrame:
    """Cast every column to the type of the same-named schema field.

    ``lenient`` uses ``try_cast`` so a malformed cell becomes null instead of
    failing the job under ANSI mode, the per-cell rule of Spark 4 (D1).
    """
    out = []
    for field in schema.fields:
        c = F.col(field.name)
        c = c.try_cast(field.dataType) if lenient else c.cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


def to_date_column(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``cast(col as date)``."""
    return df.withColumn(out or col, F.to_date(F.col(col)))


def floats_to_double(df: DataFrame) -> DataFrame:
    """Cast every float column to double, as the document store requires."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
