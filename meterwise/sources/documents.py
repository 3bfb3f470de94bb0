"""Document-store source and sink.

The connector is a format name plus options, both parameters (D11); the default
is ``mongodb``, the name the current public connector registers. No connector is
installed in the test environment, so tests stop at option building and type
preparation; nothing here fakes a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterwise.operators.clean import floats_to_double

DEFAULT_FORMAT = "mongodb"


def read_documents(spark: SparkSession, options: dict[str, str] | None = None,
                   fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The collection named by ``options`` (or the session's input URI)."""
    return spark.read.format(fmt).options(**(options or {})).load()


def prepare_for_documents(df: DataFrame) -> DataFrame:
    """The store has no float type: cast floats to double first."""
    return floats_to_double(df)


def document_writer(df: DataFrame, options: dict[str, str] | None = None,
                    mode: str = "append", fmt: str = DEFAULT_FORMAT):
    """A configured writer; ``append`` re-run duplicates, so ``overwrite`` is offered."""
    return prepare_for_documents(df).write.format(fmt).mode(mode).options(**(options or {}))


def write_documents(df: DataFrame, options: dict[str, str] | None = None,
                    mode: str = "append", fmt: str = DEFAULT_FORMAT) -> None:
    """Append to the default or a named ``database``/``collection`` (K4, K5)."""
    document_writer(df, options, mode, fmt).save()
