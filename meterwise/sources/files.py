"""File sources.

Readers always take an explicit schema where the data has one; inference is
for exploration only (it costs a full extra pass over the input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.operators.clean import NULL_MARKER, cast_to_schema, drop_header_rows, rename_positional
from meterwise.schemas import READING_SCHEMA


def read_readings_csv(spark: SparkSession, path: str | list[str],
                      schema: T.StructType = READING_SCHEMA, header: bool = True,
                      mode: str = "PERMISSIVE", null_value: str | None = None,
                      timestamp_format: str | None = None) -> DataFrame:
    """CSV with a declared positional schema; the header line is skipped.

    Any URI scheme the cluster's file systems know works (``hdfs://``, ``gs://``,
    ``s3a://``, ``file://``). ``PERMISSIVE`` turns a bad cell into null (D1);
    ``null_value`` names a missing-cell marker such as ``Null`` (S13).
    Blank padding around cells is ignored.
    """
    reader = (spark.read.schema(schema)
              .option("header", header)
              .option("mode", mode)
              .option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if timestamp_format is not None:
        reader = reader.option("timestampFormat", timestamp_format) \
                       .option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def read_tolerant_csv(spark: SparkSession, path: str | list[str],
                      schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Bulk load of a file with bad cells and ``Null`` markers."""
    return read_readings_csv(spark, path, schema, header=True, mode="PERMISSIVE",
                             null_value=NULL_MARKER)


def read_quarantined_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = READING_SCHEMA,
                         null_value: str = NULL_MARKER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bad cells reported instead of silently null (S13): ``(good, rejected, reasons)``.

    ``good`` has the schema's types; a cell that is empty or holds the marker is null there. ``rejected`` has the
    cells as text and ``_reasons``: for each bad cell its column, or ``_line`` where the line has another
    number of cells than the schema. ``reasons`` counts them: ``reason, n_cells``.
    """
    line = "_line"
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(line, T.StringType())])
    raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
           .option("enforceSchema", True).option("nullValue", null_value)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema}
    bad = [F.when(F.col(f"`{n}`").isNotNull() & t.isNull(), F.lit(n)) for n, t in typed.items()]
    judged = raw.withColumn("_reasons", F.array_compact(F.array(*bad, F.when(F.col(line).isNotNull(), F.lit(line)))))
    good = judged.filter(F.size("_reasons") == 0).select(*(t.alias(n) for n, t in typed.items()))
    rejected = judged.filter(F.size("_reasons") > 0)
    reasons = rejected.select(F.explode("_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_cells"))
    return good, rejected, reasons


def read_csv_strings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header names taken from the file, every column a string (S3)."""
    return spark.read.option("header", True).csv(path)


def read_csv_headerless(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """No header, no schema: ``_c0 ...`` strings; a header line arrives as data."""
    return spark.read.csv(path)


def repair_headerless(df: DataFrame, schema: T.StructType = READING_SCHEMA,
                      key: str | None = None) -> DataFrame:
    """S4 repaired: positional names (P4), header lines dropped (F4), typed."""
    named = rename_positional(df, schema.fieldNames())
    key = key or schema.fieldNames()[0]
    return cast_to_schema(drop_header_rows(named, key), schema)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columnar scan with pushed filters and pruned columns."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_json(spark: SparkSession, path: str | list[str],
              schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; a missing field reads as null (S7). Pass a schema in production."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in column ``value`` (S8, and S9 as a DataFrame)."""
    return spark.read.text(path)
