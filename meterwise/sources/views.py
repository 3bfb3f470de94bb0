"""Named views and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """``createOrReplaceTempView``: the analyser inlines the frame's plan into SQL."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Register ``views`` by keyword name, then run ``text`` over them."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text)
