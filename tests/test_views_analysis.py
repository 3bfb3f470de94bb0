"""S10-S12 and the chart-ready analysis frames."""

import pytest

from meterwise.plans import analysis
from meterwise.plans.standins import readings, table
from meterwise.sources import documents, views
from conftest import SF001


def test_s11_s12_views_and_sql(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    out = views.sql(spark, "SELECT k, SUM(v) AS s FROM t GROUP BY k", t=df)
    assert {r.k: r.s for r in out.collect()} == {"a": 4.0, "b": 5.0}
    views.register(df, "t2")
    assert spark.sql("SELECT COUNT(*) AS n FROM t2").first().n == 3


def test_chart_frames_are_small_aggregates(spark):
    frames = analysis.chart_frames(readings(table(spark, SF001, "lineitem")))
    assert set(frames) == {"monthly_mean_by_group", "monthly_mean_by_tariff",
                           "total_by_group", "mean_by_group"}
    assert frames["total_by_group"].count() == 3
    # The drop in prepare() leaves only the columns the analysis needs (P5).
    prepared = analysis.prepare(readings(table(spark, SF001, "lineitem")))
    assert prepared.columns == ["stdorToU", "KWH_per_hh_per_30min", "Acorn_grouped", "Month",
                                "year_num", "month_num"]


def test_s10_document_reader_needs_a_connector(spark):
    with pytest.raises(Exception):
        documents.read_documents(spark, {"database": "power", "collection": "data"}).count()
