"""Null rules equal ``na.drop`` and push down."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import N_COMPLETE, N_ROWS, meter_csv
from meterwise.operators import clean
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD, TIME
from meterwise.sources import files, sinks


@pytest.fixture()
def readings(spark, out):
    return files.read_readings_csv(spark, meter_csv(out))


def rows(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("kwargs", [
    {}, {"how": "all"}, {"thresh": 2}, {"thresh": 5}, {"subset": [ENERGY]},
    {"subset": [HOUSEHOLD, GROUP], "how": "all"},
])
def test_f8_f11_same_rows_as_na_drop(readings, kwargs):
    assert rows(clean.drop_incomplete(readings, **kwargs)) == rows(readings.na.drop(**kwargs))


def test_f8_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "v double, s string")
    assert rows(clean.drop_incomplete(df)) == rows(df.na.drop())
    assert clean.drop_incomplete(df).count() == 1


def test_f8_count_invariant(readings):
    kept = clean.drop_incomplete(readings).count()
    assert kept == N_COMPLETE
    assert readings.count() - kept == N_ROWS - N_COMPLETE


def test_f8_filters_reach_parquet_scan(spark, readings, out):
    path = sinks.write_parquet(readings, os.path.join(out, "p"))
    plan = clean.drop_incomplete(files.read_parquet(spark, path))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(LCLid)" in plan
    reference = files.read_parquet(spark, path).na.drop()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" in reference  # why the helper spells it out


def test_f6_null_rows(readings):
    assert clean.null_rows(readings, ENERGY).count() == 3


def test_f12_marker_in_any_column(spark):
    df = spark.createDataFrame([("a", "Null", 1.0), ("b", "x", 2.0), ("Null", "y", None)],
                               "k string, g string, v double")
    assert [r.k for r in clean.drop_marked(df).collect()] == ["b"]
    replaced = clean.replace_marker(df, subset=["g"]).filter(F.col("k") == "Null").count()
    assert replaced == 1  # only the named column was changed


def test_p4_f4_p6_positional_repair(spark):
    raw = spark.createDataFrame([("LCLid", "KWH"), ("M1", "0.5"), ("M2", "bad"), (None, "1")],
                                "_c0 string, _c1 string")
    named = clean.rename_positional(raw, ["LCLid", "kwh"])
    body = clean.drop_header_rows(named, "LCLid")
    assert body.count() == 2  # header and the null id go
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("LCLid", T.StringType()), T.StructField("kwh", T.DoubleType())])
    typed = clean.cast_to_schema(body, schema)
    assert sorted((r.LCLid, r.kwh) for r in typed.collect()) == [("M1", 0.5), ("M2", None)]
    with pytest.raises(ValueError):
        clean.rename_positional(raw, ["only_one"])


def test_p7_to_date(readings):
    d = clean.to_date_column(readings, TIME, "day").filter(F.col(ENERGY) == 0.143).first()
    assert str(d.day) == "2012-10-12"


def test_drop_incomplete_rejects_bad_how(readings):
    with pytest.raises(ValueError):
        clean.drop_incomplete(readings, how="some")
