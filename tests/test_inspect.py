"""Bounded collection and the schema profile."""

import pytest

from meterwise.operators import inspect as I


def test_k8_k11_bounded(spark):
    small = spark.range(5)
    assert len(I.collect_bounded(small, 5)) == 5
    assert len(I.to_pandas_bounded(small, 10)) == 5
    with pytest.raises(I.TooLargeToCollect):
        I.collect_bounded(spark.range(100), 10)
    assert [r.id for r in I.head(spark.range(10).orderBy("id"), 3)] == [0, 1, 2]


def test_k10_profile_and_shape(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, "b")], "x int, s string")
    prof = {r.column: (r.position, r.data_type, r.nulls) for r in I.schema_profile(df).collect()}
    assert prof == {"x": (0, "int", 1), "s": (1, "string", 1)}
    assert I.shape(df) == (3, 2)


def test_k9_show(spark, capsys):
    I.show(spark.range(2), 1)
    assert "only showing top 1 row" in capsys.readouterr().out


def test_small_frame_is_jvm_side(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("m", T.StringType()), T.StructField("v", T.DoubleType()),
                           T.StructField("n", T.LongType())])
    df = I.small_frame(spark, [("a", 1.5, 3), ("b", None, 4)], schema)
    assert df.schema.simpleString() == schema.simpleString()
    assert [tuple(r) for r in df.collect()] == [("a", 1.5, 3), ("b", None, 4)]
    assert I.small_frame(spark, [], schema).count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Scan ExistingRDD" not in plan
