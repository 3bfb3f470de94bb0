"""End-to-end batch jobs (§3.1, §3.3, §3.4).

Each job takes the session from its caller. Intermediate data is written to the
shared folder (``spark.checkpoint.dir``) or to paths the caller names, never to
a machine-local temporary folder, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators.clean import drop_incomplete
from meterwise.operators.consumption import in_range
from meterwise.operators.wordcount import pair_text, word_count
from meterwise.schemas import PEOPLE_SCHEMA, READING_SCHEMA, TIME
from meterwise.session import delete_path, scratch_path, shuffle_width
from meterwise.sources import documents as D
from meterwise.sources.files import read_json, read_parquet, read_readings_csv, read_text
from meterwise.sources.sinks import with_month_partitions, write_csv, write_parquet, write_text
from pyspark.sql import types as T


def load_readings(spark: SparkSession, csv_path: str | list[str], parquet_path: str,
                  schema: T.StructType = READING_SCHEMA, mode: str = "overwrite",
                  partition_by_month: bool = False,
                  document_options: dict[str, str] | None = None,
                  document_format: str = D.DEFAULT_FORMAT) -> DataFrame:
    """CSV -> declared schema -> drop incomplete rows -> Parquet -> (documents) (§3.1).

    The frame is re-bound to the Parquet copy after the write: later actions
    (the document write, counts, analysis) read the columnar copy instead of
    re-parsing the CSV. The scan -> filter -> write stage has no shuffle and
    splits the CSV into ``maxPartitionBytes`` tasks, so it scales with the
    number of cores. ``partition_by_month`` lays the copy out by year/month for
    partition pruning of later month filters.
    """
    raw = read_readings_csv(spark, csv_path, schema)
    clean = drop_incomplete(raw)
    if partition_by_month:
        # Range-partition on (year, month, time) first: each task then writes one
        # or two month folders instead of every task writing every month (file
        # explosion), and a month holding a third of the rows is split across
        # many tasks by the range bounds instead of landing in one.
        # A row-unique trailing key also splits a single hot time stamp.
        # The CSV is parsed once, into a flat copy; range sampling reads that copy.
        write_parquet(clean, flat := scratch_path(spark, "flat-readings"), mode)
        flat_rows = read_parquet(spark, flat)
        laid_out = (with_month_partitions(flat_rows)
                    .repartitionByRange(shuffle_width(flat_rows), "year", "month", TIME,
                                        F.monotonically_increasing_id()))
        write_parquet(laid_out, parquet_path, mode, ["year", "month"])
        delete_path(spark, flat)
        staged = read_parquet(spark, parquet_path).drop("year", "month")
    else:
        write_parquet(clean, parquet_path, mode)
        staged = read_parquet(spark, parquet_path)
    if document_options is not None:
        D.write_documents(staged, document_options, mode="append", fmt=document_format)
    return staged


def people_job(spark: SparkSession, json_path: str, parquet_path: str,
               csv_out: str | None = None, schema: T.StructType | None = PEOPLE_SCHEMA,
               low: int = 13, high: int = 19, parquet_out: str | None = None) -> DataFrame:
    """JSON -> Parquet (must not exist) -> names in an age range -> CSV, Parquet (§3.4).

    ``schema=None`` infers the JSON schema as the original did; that costs an
    extra pass over the input, so production runs pass the declared schema.
    """
    people = read_json(spark, json_path, schema)
    write_parquet(people, parquet_path, mode="errorifexists")
    found = in_range(read_parquet(spark, parquet_path), "age", low, high).select("name")
    if csv_out is not None:
        write_csv(found, csv_out, mode="overwrite")
    if parquet_out is not None:
        write_parquet(found, parquet_out, mode="errorifexists")
    return found


def word_count_job(spark: SparkSession, text_path: str, out_csv: str | None = None,
                   out_pairs: str | None = None,
                   document_options: dict[str, str] | None = None,
                   document_format: str = D.DEFAULT_FORMAT,
                   staging_path: str | None = None) -> DataFrame:
    """Text file -> words -> counts, descending -> CSV, ``(word, n)`` text and/or
    a document collection (X10, K3, K6, K4).

    The counts are computed once and staged as Parquet (in the shared scratch
    folder unless ``staging_path`` is given); every output and the returned
    frame read that copy, so the corpus is scanned and aggregated one time only.
    """
    staged_path = write_parquet(word_count(read_text(spark, text_path), ordered=False),
                                staging_path or scratch_path(spark, "word-counts"))
    counts = read_parquet(spark, staged_path).sort(F.col("count").desc(), F.col("word").asc())
    if out_csv is not None:
        write_csv(counts, out_csv, mode="overwrite")
    if out_pairs is not None:
        write_text(counts.select(pair_text().alias("value")), out_pairs, mode="overwrite")
    if document_options is not None:
        D.write_documents(counts, document_options, mode="append", fmt=document_format)
    return counts


def export_documents(spark: SparkSession, parquet_path: str, document_options: dict[str, str],
                     document_format: str = D.DEFAULT_FORMAT, mode: str = "append") -> int:
    """Staged Parquet -> row count -> document collection.

    Returns the number of rows sent. The count and the write are two jobs over
    the columnar copy; neither touches the original CSV.
    """
    staged = read_parquet(spark, parquet_path)
    n = staged.count()
    D.write_documents(staged, document_options, mode=mode, fmt=document_format)
    return n


def analysis_job(spark: SparkSession, parquet_path: str, out_path: str | None = None,
                 document_options: dict[str, str] | None = None,
                 document_format: str = D.DEFAULT_FORMAT) -> DataFrame:
    """§3.3: staged readings -> ``consumption`` view -> monthly tariff means -> save.

    The result (one row per month and tariff) goes to Parquet and/or appends to
    a named document collection; it is read back from Parquet when written.
    """
    from meterwise.plans import analysis

    result = analysis.run_sql(spark, read_parquet(spark, parquet_path),
                              analysis.MONTHLY_MEAN_BY_TARIFF_SQL)
    if out_path is not None:
        # Aggregate once: the document copy is sent from the saved result.
        write_parquet(result, out_path, mode="overwrite")
        result = read_parquet(spark, out_path)
    if document_options is not None:
        D.write_documents(result, document_options, mode="append", fmt=document_format)
    return result
