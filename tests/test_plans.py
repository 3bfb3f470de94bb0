"""Scale checks on the physical plans of the registered queries."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from meterwise.plans import catalog

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_plan(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF001))
    assert not any(node in plan for node in PYTHON_NODES), plan


def test_pruned_scan_and_partial_aggregate(spark):
    df = catalog.QUERIES["monthly_mean_by_group"](spark, SF001)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    read_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    for col in ("l_shipdate", "l_quantity", "l_returnflag"):
        assert col in read_schema
    assert "l_comment" not in read_schema and "l_orderkey" not in read_schema
    assert "partial_avg" in text


def test_filters_pushed_to_parquet(spark):
    plan = plan_of(catalog.QUERIES["filter_equality"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)]" in plan


def test_top_k_is_not_a_full_sort(spark):
    plan = plan_of(catalog.QUERIES["top_readings"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_contrast_is_one_aggregate(spark):
    plan = plan_of(catalog.QUERIES["tariff_contrast_total"](spark, SF001))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_energy_filter_pushed_on_staged_readings(spark, tmp_path):
    from meterwise.operators import consumption as C
    from meterwise.plans.standins import readings, table
    from meterwise.sources import files, sinks
    path = sinks.write_parquet(readings(table(spark, SF001, "lineitem")), str(tmp_path / "staged"))
    plan = plan_of(C.above(files.read_parquet(spark, path), 1))
    assert "GreaterThan(KWH_per_hh_per_30min,1.0)" in plan


def test_shuffle_width_follows_input_bytes_and_runs_no_job(spark):
    from meterwise.session import input_bytes, shuffle_width
    st = spark.sparkContext.statusTracker()
    lineitem = spark.read.parquet(f"{SF001}/lineitem.parquet")
    for df in (lineitem, lineitem.groupBy("l_suppkey").count()):
        before = len(st.getJobIdsForGroup())
        shuffle_width(df)
        assert len(st.getJobIdsForGroup()) == before
    exchange = lineitem.withColumnRenamed("l_comment", "Exchange") if "l_comment" in lineitem.columns else lineitem.withColumn("Exchange", F.lit(1))
    assert input_bytes(exchange) == input_bytes(lineitem) > 100_000
    assert input_bytes(lineitem.join(lineitem.select("l_orderkey").distinct(), "l_orderkey")) >= input_bytes(lineitem)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert shuffle_width(exchange) >= 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256m")


# Where a window or broadcast is allowed, and why its size is bounded:
# index_*, trees_on_group - the row-index offsets (one row per partition) and the
#   code table (one row per distinct value, broadcast only under the size threshold);
# count_vector - the vocabulary (vocab_size rows).
# fine_totals - one row for each of three groups.
CODED = {"Window", "BroadcastExchange"}
BOUNDED = {"index_household_join": CODED, "index_frequency": CODED, "index_alphabetical": CODED,
           "index_with_nulls": CODED, "trees_on_group": CODED, "fine_totals": {"BroadcastExchange"},
           "count_vector": {"BroadcastExchange"}, "group_classification": CODED,
           # Ranks within a group of tasks, behind a group limit of k rows on both sides of the shuffle.
           "top_readings": {"Window"}, "lowest_readings": {"Window"}}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_scale_rules(spark, name):
    df = catalog.QUERIES[name](spark, SF001)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for node in ("Window", "BroadcastExchange"):
        if node in text:
            assert node in BOUNDED.get(name, set()), f"{name} has an unexpected {node}"
