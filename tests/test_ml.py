"""M1-M15 and the distributed row index."""

import datetime as dt
import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterwise.operators import ml as ML
from meterwise.operators.rowindex import with_row_index
from meterwise.operators.selection import positional_split, select_at
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD


@pytest.fixture(scope="module")
def table(spark):
    # 40 households (more than the default 32 bins), 4 groups, energy = a + b*h + c*g exactly.
    rows = []
    for h in range(40):
        for k in range(h % 3 + 1):
            g = ["Affluent", "Comfortable", "Adversity", "ACORN-U"][h % 4]
            rows.append((f"MAC{h:06d}", g, f"ACORN-{chr(65 + h % 5)}", 0.1 * k + 0.01 * h))
    return spark.createDataFrame(rows, f"{HOUSEHOLD} string, {GROUP} string, Acorn string, {ENERGY} double")


def codes(df, col, out):
    return {r[col]: r[out] for r in df.select(col, out).distinct().collect()}


def test_m1_frequency_codes_ties_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in "bbbaacc"], "v string")
    assert codes(ML.index(df, "v", "c"), "v", "c") == {"b": 0.0, "a": 1.0, "c": 2.0}


def test_m10_alphabetical_codes_and_labels(spark):
    df = spark.createDataFrame([(v,) for v in "bbbaacc"], "v string")
    assert codes(ML.index(df, "v", "c", order="alphabetAsc"), "v", "c") == {"a": 0.0, "b": 1.0, "c": 2.0}
    assert ML.labels(df, "v", 10, "alphabetAsc") == ["a", "b", "c"]


def test_row_index_matches_row_number(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = with_row_index(df.repartition(7), ["k"], "i")
    expected = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("i"))
    assert sorted(got.collect()) == sorted(expected.collect())


def test_m11_positional_split(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"))
    train, test = positional_split(df.repartition(5), ["k"], 0.8)
    assert sorted(r.k for r in train.collect()) == list(range(80))
    assert sorted(r.k for r in test.collect()) == list(range(80, 100))


def test_m3_seeded_and_hash_split(table):
    a1, b1 = ML.random_split(table, seed=7)
    a2, b2 = ML.random_split(table, seed=7)
    assert sorted(a1.collect(), key=repr) == sorted(a2.collect(), key=repr)
    assert a1.count() + b1.count() == table.count()
    h1, h2 = ML.hash_split(table, [HOUSEHOLD, ENERGY])
    assert h1.count() + h2.count() == table.count()
    again, _ = ML.hash_split(table.repartition(3), [HOUSEHOLD, ENERGY])
    assert sorted(h1.collect(), key=repr) == sorted(again.collect(), key=repr)


def test_m2_m4_ols_recovers_exact_line(spark):
    df = spark.createDataFrame([(float(x), float(y), 1.5 + 2.0 * x - 0.5 * y)
                                for x in range(10) for y in range(5)], "x double, y double, z double")
    model = ML.linear_fit(df, ["x", "y"], "z")
    assert list(model.coefficients) == pytest.approx([2.0, -0.5])
    assert model.intercept == pytest.approx(1.5)


def test_d13_trees_take_the_household_code_as_a_number(table):
    feats = ML.household_group_features(table)
    model = DecisionTreeRegressor(labelCol=ENERGY, featuresCol="features").fit(feats)
    assert model.numFeatures == 2
    assert [a["name"] for a in feats.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]] == ["group_code"]


def test_m5_m9_compare_models(spark, table):
    feats = ML.household_group_features(table)
    train, test = ML.random_split(feats, seed=1)
    scores = ML.compare_models(spark, train, test, ENERGY,
                               models=["linear_regression", "decision_tree"])
    rows = {r.model: r for r in scores.collect()}
    assert set(rows) == {"linear_regression", "decision_tree"}
    for r in rows.values():
        assert r.rmse == pytest.approx(r.mse ** 0.5) and r.mae >= 0
    # Our one-pass scores equal RegressionEvaluator's.
    model = ML.regressors(ENERGY)["linear_regression"].fit(train)
    preds = model.transform(test)
    mine, theirs = ML.scores(preds, ENERGY), ML.evaluator_scores(preds, ENERGY)
    for m in ML.METRICS:
        assert mine[m] == pytest.approx(theirs[m])
    assert ML.exact_accuracy(preds, ENERGY) == pytest.approx(mine["exact_share"])


def test_m12_label_encoded_regression(spark, table):
    out = ML.label_encoded_regression(spark, table, [GROUP, HOUSEHOLD, "Acorn"], ENERGY,
                                      [HOUSEHOLD, ENERGY, GROUP, "Acorn"])
    r = out.first()
    assert r.n_test == table.count() - int(table.count() * 0.8) and r.mae >= 0


def test_m13_count_vectorizer(spark):
    df = spark.createDataFrame([("a b a",), ("b c",), ("a",)], "t string")
    model, vecs = ML.count_vectorize(df, "t", vocab_size=2)
    assert model.vocabulary == ["a", "b"]
    assert vecs.select("counts").first()[0].toArray().tolist() == [2.0, 1.0]


def test_m14_pipeline(table):
    fitted = ML.indexing_pipeline(ENERGY, max_bins=40).fit(table)
    assert fitted.transform(table).select("prediction").count() == table.count()


def test_row_index_splits_a_hot_key(spark):
    # Every row has the same order key: the tie-breaker still spreads them over tasks.
    df = spark.range(0, 2000, numPartitions=4).select(F.lit(1).alias("k"), "id")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # keep AQE from merging the tiny test partitions
    try:
        got = with_row_index(df, ["k"], "i")
        assert sorted(r.i for r in got.select("i").collect()) == list(range(2000))
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set(key, "true")


def test_index_many_matches_single_and_sizes(table):
    coded, sizes = ML.index_many(table, [HOUSEHOLD, GROUP], ["h", "g"])
    assert codes(coded, HOUSEHOLD, "h") == codes(ML.index(table, HOUSEHOLD, "h"), HOUSEHOLD, "h")
    assert codes(coded, GROUP, "g") == codes(ML.index(table, GROUP, "g"), GROUP, "g")
    assert sizes == {"h": 40, "g": 4}


@pytest.mark.parametrize("order", ["frequencyDesc", "frequencyAsc", "alphabetAsc", "alphabetDesc"])
def test_one_pass_index_equals_fitted_string_indexer(spark, table, order):
    from pyspark.ml.feature import StringIndexer
    words = spark.createDataFrame([(v,) for v in ["b", "ab", "abc", "B", "é", "ab", "b", "z", "ab"]], "v string")
    for df, col in ((table, HOUSEHOLD), (table, GROUP), (words, "v")):
        fitted = StringIndexer(inputCol=col, outputCol="c", stringOrderType=order).fit(df).transform(df)
        assert codes(ML.index(df, col, "c", order=order), col, "c") == codes(fitted, col, "c")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_codes_nulls_and_metadata_do_not_depend_on_the_join(spark, threshold):
    rows = [("a",), ("a",), (None,), ("\uff5e",), ("\U0001f600",), ("b",)]
    df = spark.createDataFrame(rows, "v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        coded, sizes = ML.index_many(df, ["v"], ["c"])
        assert {(r.v, r.c) for r in coded.collect()} == {
            ("a", 0.0), ("b", 1.0), ("\uff5e", 2.0), ("\U0001f600", 3.0), (None, None)}
        assert coded.schema["c"].metadata["ml_attr"] == {"type": "nominal", "name": "c", "num_vals": 4} and sizes == {"c": 4}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_m11_selection_equals_sorting(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1.5, 2.5, float("nan")]), rnd.randint(0, 3), dt.datetime(2013, 1, rnd.randint(1, 3)))
            for _ in range(300)] + [("b", 2.5, 1, dt.datetime(2013, 1, 1))] * 200
    df = spark.createDataFrame(rows, "s string, x double, i int, t timestamp_ntz").repartition(7)
    rank = lambda v: (v is not None, v is not None and v != v, v if v is not None and v == v else 0)
    key = lambda r: ((r[0] is not None, r[0] or ""), rank(r[1]), r[2], r[3])
    for order, k in ((["s", "x"], 10), (["s", "x"], 350), (["x", "t"], 499), ([], 250)):
        cut = select_at(df, order, k)
        assert cut.before <= k < cut.before + cut.equal
        assert df.filter(cut.precedes()).count() == cut.before and df.filter(cut.equals()).count() == cut.equal
    train, test = positional_split(df, ["s", "x", "i", "t"], 0.7)
    want = sorted(rows, key=key)
    assert [key(r) for r in sorted((tuple(r) for r in train.collect()), key=key)] == [key(r) for r in want[:350]]
    assert [key(r) for r in sorted((tuple(r) for r in test.collect()), key=key)] == [key(r) for r in want[350:]]
    for fraction in (0.0, 1.0):
        assert positional_split(df, ["s"], fraction)[0].count() == int(500 * fraction)


def test_m11_split_moves_no_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    train, _ = positional_split(df, ["l_orderkey", "l_linenumber"], 0.8)
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "PushedFilters: [Or(" in plan


def test_m13_vectors_sum_to_counts_and_ties_by_term(spark):
    df = spark.createDataFrame([("b a b",), ("c a",), (None,), ("d d c",)], "t string")
    model, vectors = ML.count_vectorize(df, "t", vocab_size=3)
    assert [tuple(r) for r in ML.vocabulary_counts(model, vectors).orderBy("term_index").collect()] == [(0, "a", 2), (1, "b", 2), (2, "c", 2)]
    assert ML.count_vectorize(df, "t", vocab_size=3, min_df=2)[0].vocabulary == ["a", "c"]


def test_m15_fitted_shares_and_log_loss(spark, table):
    found = ML.classify_group(table)
    shares = found["shares"].collect()
    assert all(r.fitted_share == pytest.approx(r.observed_share, abs=1e-5) for r in shares)
    entropy = -sum(r.observed_share * math.log(r.observed_share) for r in shares)
    assert 0 < found["log_loss"] <= entropy + 1e-9 and 0 < found["accuracy"] <= 1


def test_m14_saved_pipeline_predicts_alike(spark, table, out):
    model = ML.persisted_pipeline(table, out + "/pipeline")
    again = PipelineModel.load(out + "/pipeline")
    rows = table.filter(F.col(GROUP).isNotNull())
    assert sorted(r.prediction for r in model.transform(rows).collect()) == sorted(r.prediction for r in again.transform(rows).collect())


def test_m9_scores_do_not_depend_on_partitions(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    seen = []
    for n in (1, 4):
        coded, _ = ML.index_many(lines.repartition(n), ["l_returnflag"], ["code"])
        train, test = ML.hash_split(ML.assemble(coded, ["code"]), ["l_orderkey", "l_linenumber"])
        scores = ML.compare_models(spark, train, test, "l_quantity", learners=ML.cell_learners("l_quantity"))
        seen.append([(r.model, round(r.mae, 9), round(r.mse, 9), r.n_test) for r in scores.collect()])
    assert seen[0] == seen[1]


def cell_rows(spark, n):
    """Skewed numeric codes, a nominal code and a label, in one partition."""
    rows = spark.range(0, n, 1, 1).select(
        F.floor(F.lit(3000) * F.pow(F.rand(1), 3)).cast("double").alias("a"),
        F.col("id").cast("double").alias("_id"), (F.col("id") % 3).cast("double").alias("b", metadata={"ml_attr": {"type": "nominal", "name": "b", "num_vals": 3}}))
    return ML.assemble(rows, ["a", "b"]).select("features", (F.sin("a") + F.sqrt("a") * F.col("b") + F.rand(2)).alias("y"))


def test_boosted_trees_are_fitted_on_cells_and_score_as_on_rows(spark, tmp_path, monkeypatch):
    made = cell_rows(spark, 30_000)  # more than the 10,000 rows from which Spark draws the candidate splits
    made.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema(made.schema).parquet(str(tmp_path / "rows"))
    learner = ML.GBTRegressor(labelCol="y", maxIter=4, maxBins=16, seed=42)
    on_rows = learner.fit(rows)
    want = ML.scores(on_rows.transform(rows), "y")
    seen, fit = [], ML.GBTRegressor.fit
    monkeypatch.setattr(ML.GBTRegressor, "fit", lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1])
    got = ML.compare_models(spark, rows, rows, "y", learners={"gbt": learner}).first()
    assert got.n_test == 30_000 and seen and max(seen) <= 3 * 20
    assert all(got[m] == pytest.approx(want[m], rel=1e-9) for m in ML.METRICS)
    model, celled = ML.fit_on_cells(learner, rows, "y", "features", str(tmp_path / "cells"))
    same = model.transform(celled(on_rows.transform(rows).withColumnRenamed("prediction", "on_rows")))
    assert same.filter(F.abs(F.col("prediction") - F.col("on_rows")) > 1e-9).isEmpty()


def test_cells_of_constant_features_few_rows_and_null_labels(spark, tmp_path):
    rows = cell_rows(spark, 40)
    learner = ML.GBTRegressor(labelCol="y", maxIter=2, seed=42)
    one = ML.assemble(rows.select(F.lit(7.0).alias("c"), "y"), ["c"])
    for name, df in (("few", rows), ("constant", one)):
        want = ML.scores(learner.fit(df).transform(df), "y")
        model, celled = ML.fit_on_cells(learner, df, "y", "features", str(tmp_path / name))
        got = ML.scores(model.transform(celled(df)), "y")
        assert all(got[m] == pytest.approx(want[m], rel=1e-9, abs=1e-9) for m in ML.METRICS)
    nulls = rows.withColumn("y", F.when(F.col("y") > 5, F.col("y")))
    with pytest.raises(Exception, match="(?i)null"):
        ML.fit_on_cells(learner, nulls, "y", "features", str(tmp_path / "nulls"))
    for other in (ML.GBTRegressor(lossType="absolute"), ML.GBTRegressor(subsamplingRate=0.5), ML.GBTRegressor(minInstancesPerNode=2),
                  ML.GBTRegressor(weightCol="w"), ML.DecisionTreeRegressor()):
        assert not ML.fits_cells(other, rows, "features")
    assert ML.fits_cells(learner, rows, "features") and not ML.fits_cells(learner, spark.createDataFrame(rows.collect()), "features")
