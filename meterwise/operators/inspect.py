"""Looking at results without pulling tables to the driver.

Only frames with a known small size may be collected: an aggregate over a
bounded key set, or an explicit ``limit``. The caller states the bound; a helper
fetches at most one row more, once, and refuses a larger frame.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class TooLargeToCollect(ValueError):
    pass


def _bounded(rows, max_rows: int):
    if len(rows) > max_rows:
        raise TooLargeToCollect(f"more than {max_rows} rows; aggregate or limit first")
    return rows


def to_pandas_bounded(df: DataFrame, max_rows: int):
    """``toPandas()`` of an already aggregated frame (K8)."""
    return _bounded(df.limit(max_rows + 1).toPandas(), max_rows)


def collect_bounded(df: DataFrame, max_rows: int):
    """``collect()`` of at most ``max_rows`` rows."""
    return _bounded(df.limit(max_rows + 1).collect(), max_rows)


def head(df: DataFrame, n: int = 20):
    """First ``n`` rows as a list (O6); give ``df`` an order for a stable answer."""
    return df.limit(n).collect()


def show(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print the first ``n`` rows (K9)."""
    df.show(n, truncate=truncate)


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, position and null count.

    The null counts come from a single distributed aggregate over the table; the
    result has as many rows as the table has columns.
    """
    fields = df.schema.fields
    nulls = df.agg(*[F.sum(F.col(f.name).isNull().cast("long")).alias(f"n{i}")
                     for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.coalesce(F.col(f"n{i}"), F.lit(0).cast("long")).alias("nulls"))
            for i, f in enumerate(fields)]
    return nulls.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns), like pandas ``shape``."""
    return df.count(), len(df.columns)


def small_frame(spark, rows, schema: T.StructType) -> DataFrame:
    """A frame of a few driver-side values (metrics, coefficients, a vocabulary).

    Built from literals on the JVM side (``range(1)`` + ``inline``), so no Python
    worker is started and no RDD is parallelised for a handful of numbers.
    """
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in schema.fields])
    return spark.range(1).select(F.inline(F.array(*structs)))
