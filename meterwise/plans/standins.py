"""Stand-ins: the meter tables expressed over the driver's TPC-H-like tables.

The original readings file is not available, so ``lineitem`` plays it (§7.4):

* household ``LCLid``      <- ``l_suppkey`` as text
* tariff ``stdorToU``      <- ``l_linestatus`` (``O`` plays the warned group)
* time ``DateTime``        <- ``l_shipdate``
* energy (kWh)             <- ``l_quantity / 10`` (0.1 .. 5.0, like the meters)
* fine group ``Acorn``     <- ``l_returnflag || '-' || l_linestatus``
* social group             <- ``l_returnflag`` (``A`` plays ``Adversity``)

Each stand-in is a projection, so filters and column pruning still reach the
Parquet scan of ``lineitem``. The matching DuckDB text lives next to each one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.schemas import ACORN, ENERGY, GROUP, HOUSEHOLD, TARIFF, TIME

# Fixed values of the stand-in mapping.
WARNED = "O"
FLAT = "F"
ADVERSITY = "A"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reading_columns() -> list[Column]:
    return [
        F.col("l_suppkey").cast("string").alias(HOUSEHOLD),
        F.col("l_linestatus").alias(TARIFF),
        F.col("l_shipdate").alias(TIME),
        (F.col("l_quantity") / F.lit(10)).alias(ENERGY),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias(ACORN),
        F.col("l_returnflag").alias(GROUP),
    ]


def readings(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(*reading_columns())


READINGS_SQL = f"""readings AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS {HOUSEHOLD}, l_linestatus AS {TARIFF},
         l_shipdate AS {TIME}, l_quantity / 10 AS {ENERGY},
         l_returnflag || '-' || l_linestatus AS {ACORN}, l_returnflag AS {GROUP}
  FROM lineitem)"""


def readings_with_gaps(lineitem: DataFrame) -> DataFrame:
    """Readings with missing cells, made by fixed rules (none of the tables has nulls).

    * ``l_quantity = 50``: every column missing (a wholly bad line)
    * ``l_linenumber = 7``: household missing (key only)
    * ``l_quantity > 40``: energy missing
    * ``l_discount = 0``: fine group missing
    """
    blank = F.col("l_quantity") == 50

    def unless(cond, value):
        return F.when(cond, F.lit(None)).otherwise(value)

    return lineitem.select(
        unless(blank | (F.col("l_linenumber") == 7), F.col("l_suppkey").cast("string")).alias(HOUSEHOLD),
        unless(blank, F.col("l_linestatus")).alias(TARIFF),
        unless(blank, F.col("l_shipdate")).alias(TIME),
        unless(F.col("l_quantity") > 40, F.col("l_quantity") / F.lit(10)).alias(ENERGY),
        unless(blank | (F.col("l_discount") == 0),
               F.concat_ws("-", "l_returnflag", "l_linestatus")).alias(ACORN),
        unless(blank, F.col("l_returnflag")).alias(GROUP),
    )


GAPS_SQL = f"""gaps AS (
  SELECT CASE WHEN l_quantity = 50 OR l_linenumber = 7 THEN NULL
              ELSE CAST(l_suppkey AS VARCHAR) END AS {HOUSEHOLD},
         CASE WHEN l_quantity = 50 THEN NULL ELSE l_linestatus END AS {TARIFF},
         CASE WHEN l_quantity = 50 THEN NULL ELSE l_shipdate END AS {TIME},
         CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity / 10 END AS {ENERGY},
         CASE WHEN l_quantity = 50 OR l_discount = 0 THEN NULL
              ELSE l_returnflag || '-' || l_linestatus END AS {ACORN},
         CASE WHEN l_quantity = 50 THEN NULL ELSE l_returnflag END AS {GROUP}
  FROM lineitem)"""


def people(part: DataFrame) -> DataFrame:
    """The people records: ``age <- p_size``, ``name <- p_name``."""
    return part.select(F.col("p_size").cast("long").alias("age"), F.col("p_name").alias("name"))
