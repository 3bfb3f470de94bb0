"""The analysis job (§3.2, §3.3): month key, grouped means and totals.

The same questions are asked through the DataFrame API and through SQL over the
``consumption`` view; Catalyst gives both the same plan (scan with only the
needed columns -> partial hash aggregate -> shuffle on the keys -> final
aggregate -> small sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.functions.calendar import with_month
from meterwise.operators import consumption as C
from meterwise.schemas import ACORN, ENERGY, GROUP, HOUSEHOLD, TARIFF, TIME

VIEW = "consumption"

# The SQL questions over the ``consumption`` view. Nothing is rounded
# here; callers round results where they show or compare them.
TOTAL_BY_GROUP_SQL = f"""
SELECT {GROUP}, SUM({ENERGY}) AS TotalKWH
FROM {VIEW}
GROUP BY {GROUP}
ORDER BY TotalKWH DESC
"""

MEAN_BY_GROUP_SQL = f"""
SELECT {GROUP}, AVG({ENERGY}) AS AvgKWH
FROM {VIEW}
GROUP BY {GROUP}
ORDER BY AvgKWH DESC
"""

MEAN_BY_TARIFF_SQL = f"""
SELECT {TARIFF}, AVG({ENERGY}) AS avg_KWH
FROM {VIEW}
GROUP BY {TARIFF}
ORDER BY avg_KWH DESC
"""

# Monthly questions group on the integer year and month and build the text key
# on the aggregated rows only (``||`` keeps a missing month null).
MONTHLY_MEAN_BY_TARIFF_SQL = f"""
SELECT CAST(year_num AS STRING) || '-' || CAST(month_num AS STRING) AS Month, {TARIFF},
       AVG({ENERGY}) AS avg_KWH
FROM {VIEW}
GROUP BY year_num, month_num, {TARIFF}
ORDER BY Month DESC
"""

MONTHLY_MEAN_BY_GROUP_SQL = f"""
SELECT CAST(year_num AS STRING) || '-' || CAST(month_num AS STRING) AS Month, {GROUP},
       AVG({ENERGY}) AS avg
FROM {VIEW}
GROUP BY year_num, month_num, {GROUP}
ORDER BY Month DESC
"""


def prepare(readings: DataFrame) -> DataFrame:
    """``withColumn('Month', ...)`` then drop household, time and fine group.

    Integer ``year_num`` and ``month_num`` are kept next to the text key so that
    SQL can group on them (column names are case-insensitive, hence not
    ``month``); columns a query does not use are pruned by Catalyst.
    """
    return (with_month(readings, TIME)
            .withColumn("year_num", F.year(TIME)).withColumn("month_num", F.month(TIME))
            .drop(HOUSEHOLD, TIME, ACORN))


def register_consumption(readings: DataFrame) -> DataFrame:
    """The ``consumption`` view the SQL questions read."""
    prepared = prepare(readings)
    prepared.createOrReplaceTempView(VIEW)
    return prepared


def run_sql(spark: SparkSession, readings: DataFrame, text: str) -> DataFrame:
    register_consumption(readings)
    return spark.sql(text)


def monthly_mean_by_group(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """``groupBy(['Month', group]).mean().orderBy('Month')`` with explicit names."""
    return C.monthly_mean(readings, GROUP, ENERGY, TIME, "avg", digits)


def monthly_mean_by_tariff(readings: DataFrame, digits: int | None = None) -> DataFrame:
    return C.monthly_mean(readings, TARIFF, ENERGY, TIME, "avg_KWH", digits)


def chart_frames(readings: DataFrame, digits: int | None = None) -> dict[str, DataFrame]:
    """The four chart-ready aggregates of the analysis notebook (K8 after these)."""
    return {
        "monthly_mean_by_group": monthly_mean_by_group(readings, digits),
        "monthly_mean_by_tariff": monthly_mean_by_tariff(readings, digits),
        "total_by_group": C.sum_by(readings, GROUP, ENERGY, "TotalKWH")
                           .orderBy("TotalKWH", ascending=False),
        "mean_by_group": C.mean_by(readings, GROUP, ENERGY, "AvgKWH", digits)
                          .orderBy("AvgKWH", ascending=False),
    }
