"""Aggregates, filters, order; DataFrame = SQL."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fixtures import meter_csv
from meterwise.functions.calendar import month_key_formatted
from meterwise.operators import clean
from meterwise.operators import consumption as C
from meterwise.plans import analysis as AN
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD, TARIFF, TIME
from meterwise.sources import files


@pytest.fixture()
def clean_readings(spark, out):
    return clean.drop_incomplete(files.read_readings_csv(spark, meter_csv(out))).cache()


def as_dict(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_filters(clean_readings):
    assert C.filter_text(clean_readings, f"{ENERGY} > 1").count() == 7
    assert C.above(clean_readings, 2).count() == 4  # 2 itself is not above 2
    got = C.above_in_group(clean_readings, 1, "Adversity").count()
    assert got == 3
    assert C.equal_to(clean_readings, TARIFF, "ToU").count() == 5
    assert C.in_range(clean_readings, ENERGY, 1, 2).count() == 4  # 1, 2, 1.001, 1.999


def test_a1_a5_totals_and_invariant(clean_readings):
    g = C.grand_total(clean_readings).first()
    assert g.n_rows == clean_readings.count() == C.row_count(clean_readings).first().n_rows
    by_group = C.sum_by(clean_readings, GROUP, exact_scale=3)
    assert sum(r.total for r in by_group.collect()) == pytest.approx(g.total_kwh, abs=1e-9)
    assert g.total_kwh == pytest.approx(29.173)
    # The dictionary spelling of A5 gives the same total.
    assert clean_readings.agg({ENERGY: "sum"}).first()[0] == pytest.approx(g.total_kwh)


def test_a2_a4_household_and_names(clean_readings):
    means = C.numeric_means_by(clean_readings, HOUSEHOLD, digits=4)
    assert means.columns == [HOUSEHOLD, f"avg_{ENERGY}"]
    m = as_dict(means, HOUSEHOLD, f"avg_{ENERGY}")
    assert m["MAC000002"] == pytest.approx((0.143 + 1 + 2) / 3, abs=1e-4)
    sums = as_dict(C.numeric_sums_by(clean_readings, HOUSEHOLD, exact_scale=3), HOUSEHOLD,
                   f"sum_{ENERGY}")
    assert sums["MAC000034"] == pytest.approx(19.53)


def test_a9_count_by(clean_readings):
    assert as_dict(C.count_by(clean_readings, GROUP), GROUP, "count") == {
        "Affluent": 3, "Comfortable": 3, "Adversity": 3, "ACORN-U": 2}


def test_d2_null_group_kept(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), (None, 3.0)], f"{GROUP} string, {ENERGY} double")
    assert as_dict(C.sum_by(df, GROUP), GROUP, "total") == {None: 4.0, "a": 2.0}


def test_d4_month_text_order_and_month_start(clean_readings):
    months = [r.Month for r in AN.monthly_mean_by_group(clean_readings).collect()]
    distinct = list(dict.fromkeys(months))
    assert distinct == ["2012-10", "2012-12", "2012-9", "2013-1"]  # text order, as the original
    same = clean_readings.select(
        (F.concat_ws("-", F.year(TIME), F.month(TIME)) == month_key_formatted(TIME)).alias("eq"))
    assert all(r.eq for r in same.collect())


def test_a3_dataframe_equals_sql(spark, clean_readings):
    df_side = AN.monthly_mean_by_tariff(clean_readings)
    sql_side = AN.run_sql(spark, clean_readings, AN.MONTHLY_MEAN_BY_TARIFF_SQL)
    assert sorted(df_side.collect()) == sorted(sql_side.collect())
    df_total = C.sum_by(clean_readings, GROUP, ENERGY, "TotalKWH", exact_scale=3)
    sql_total = AN.run_sql(spark, clean_readings, AN.TOTAL_BY_GROUP_SQL)
    for x, y in zip(sorted(df_total.collect()), sorted(sql_total.collect()), strict=True):
        assert x[0] == y[0] and abs(x[1] - y[1]) < 1e-9
    # The SQL result is ordered by the total, descending.
    totals = [r.TotalKWH for r in sql_total.collect()]
    assert totals == sorted(totals, reverse=True)


def test_a11_tariff_contrast(clean_readings):
    total = C.tariff_contrast(clean_readings, by_month=False).first()
    tou = [r[ENERGY] for r in clean_readings.filter(F.col(TARIFF) == "ToU").collect()]
    std = [r[ENERGY] for r in clean_readings.filter(F.col(TARIFF) == "Std").collect()]
    assert total.avg_warned == pytest.approx(sum(tou) / len(tou))
    assert total.avg_flat == pytest.approx(sum(std) / len(std))
    assert total.warned_below == (total.avg_warned < total.avg_flat)
    monthly = C.tariff_contrast(clean_readings, by_month=True)
    assert monthly.count() == 4


def test_o1_d7_top_k_ties_deterministic(clean_readings):
    top = C.top_k(clean_readings, 2)
    got = [(r[HOUSEHOLD], r[TARIFF], r[ENERGY]) for r in top.collect()]
    # Three readings tie at 6.51; the tie breakers pick the same two every time.
    assert got == [("MAC000034", "Std", 6.51), ("MAC000034", "ToU", 6.51)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_o2_d3_nulls_first(spark, out):
    raw = files.read_readings_csv(spark, meter_csv(out))
    low = C.bottom_k(raw, 3).collect()
    assert all(r[ENERGY] is None for r in low)
    desc = raw.sort(F.col(ENERGY).desc()).collect()
    assert desc[-1][ENERGY] is None  # descending puts nulls last


def test_o3_sort_desc(clean_readings):
    vals = [r[ENERGY] for r in C.sort_desc(clean_readings, ENERGY).collect()]
    assert vals == sorted(vals, reverse=True)


def test_small_readings_are_not_lost(spark):
    from meterwise.plans import analysis as AN
    df = spark.createDataFrame([("h", "Std", None, 0.0004, "a", "g")] * 10, "LCLid string, stdorToU string, DateTime timestamp, KWH_per_hh_per_30min double, Acorn string, Acorn_grouped string")
    assert abs(C.grand_total(df).first().total_kwh - 0.004) < 1e-12
    assert abs(AN.run_sql(spark, df, AN.TOTAL_BY_GROUP_SQL).first().TotalKWH - 0.004) < 1e-12
    assert abs(AN.run_sql(spark, df, AN.MEAN_BY_GROUP_SQL).first().AvgKWH - 0.0004) < 1e-12
    import pytest
    with pytest.raises(Exception, match="decimal places"):
        C.grand_total(df, exact_scale=3).collect()


def test_reproducible_sums_are_bit_equal(spark):
    rnd = random.Random(1)
    xs = [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-8, 8) for _ in range(3000)] + [None, 1e8, -1e8, 5e-324]
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(xs)], "g int, x double")
    seen = set()
    for n in (1, 7, 200):
        for order in ("x", "g"):
            rows = C.reproducible_by(df.repartition(n).sortWithinPartitions(order), "g", "x").orderBy("g").collect()
            seen.add(tuple((r.total.hex(), r.avg.hex(), r.n) for r in rows))
    assert len(seen) == 1
    for g, (total, _, n) in enumerate(next(iter(seen))):
        mine = [x for i, x in enumerate(xs) if i % 3 == g and x is not None]
        assert n == len(mine) and float.fromhex(total) == pytest.approx(math.fsum(mine), rel=1e-15)


def test_reproducible_sums_of_nothing_and_infinities(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, float("inf")), (3, 1.0), (4, float("inf")), (4, float("-inf"))], "g int, x double")
    got = {r.g: r.total for r in C.reproducible_by(df, "g", "x").collect()}
    assert got[1] is None and got[2] == 0.0 and got[3] == float("inf") and math.isnan(got[4])


def test_top_k_has_two_levels(spark):
    df = spark.range(0, 5000, numPartitions=40).select(((F.col("id") * 7919) % 1000).cast("double").alias("x"), "id")
    best = C.top_k(df, 7, by="x")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in best.collect()] == sorted(((float(i * 7919 % 1000), i) for i in range(5000)), key=lambda t: (-t[0], t[1]))[:7]
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "hashpartitioning(_bucket" in plan


def test_contrast_errors_of_a_hand_made_month(spark):
    day = dt.datetime(2013, 1, 5)
    rows = [("a", "ToU", day, 1.0), ("a", "ToU", day, 3.0), ("b", "ToU", day, 5.0), ("c", "Std", day, 2.0), ("d", "Std", day, 4.0), ("d", "Std", day, 6.0),
            ("e", "Std", day, None), (None, "Std", day, 9.0), ("f", "ToU", dt.datetime(2013, 2, 1), 1.0)]
    df = spark.createDataFrame(rows, "LCLid string, stdorToU string, DateTime timestamp_ntz, KWH_per_hh_per_30min double")
    got = {r.Month: r for r in C.contrast_errors(df).collect()}
    parts = [(4 - 2 * 3) / 3, (5 - 3) / 3, -(2 - 4) / 3, -(10 - 2 * 4) / 3]
    se = math.sqrt(sum(p * p for p in parts))
    jan = got["2013-1"]
    assert (jan["diff"], jan.std_err, jan.t_value, jan.n_households) == pytest.approx((-1.0, se, -1 / se, 4))
    assert (got["2013-2"]["diff"], got["2013-2"].std_err, got["2013-2"].t_value) == (None, None, None)
