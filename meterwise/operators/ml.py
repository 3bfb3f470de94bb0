"""Regression on meter data with distributed ``pyspark.ml``.

Everything here is a Spark ML estimator or a DataFrame expression: indexing,
assembling, splitting, fitting and scoring all run as distributed jobs. Only
model parameters and metric values (a handful of numbers) reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import CountVectorizerModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.operators.inspect import collect_bounded, small_frame
from meterwise.operators.rowindex import with_row_index
from meterwise.operators.selection import positional_flag
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD
from meterwise.session import delete_path, ensure_checkpoint_dir, scratch_path

METRICS = ("mae", "rmse", "mse", "r2")


# ---- indexing (M1, M10) ----------------------------------------------------

def index(df: DataFrame, input_col: str, output_col: str, order: str = "frequencyDesc") -> DataFrame:
    """Code a string column 0, 1, 2, ... (M1; ``order='alphabetAsc'`` is M10).

    ``frequencyDesc`` gives the most frequent value code 0, ties in code-point
    order. See :func:`index_many`.
    """
    return index_many(df, [input_col], [output_col], order)[0]


def code_table(df: DataFrame, input_col: str, order: str = "frequencyDesc") -> DataFrame:
    """``(input_col, code, n)``: each value's code and how many rows have it.

    A distributed count and row index; the table is written once to the shared folder.
    """
    counts = df.filter(F.col(input_col).isNotNull()).groupBy(input_col).agg(F.count(F.lit(1)).alias("n"))
    keys = {
        "frequencyDesc": [F.col("n").desc(), F.col(input_col).asc()],
        "frequencyAsc": [F.col("n").asc(), F.col(input_col).asc()],
        "alphabetAsc": [F.col(input_col).asc()],
        "alphabetDesc": [F.col(input_col).desc()],
    }[order]
    return with_row_index(counts, keys, "_code").select(input_col, F.col("_code").cast("double").alias("code"), "n")


def index_many(df: DataFrame, input_cols: Sequence[str], output_cols: Sequence[str],
               order: str = "frequencyDesc") -> tuple[DataFrame, dict[str, int]]:
    """Code several string columns, each by a join with its code table.

    One way at every size: Spark broadcasts a code table when its measured size is
    below the threshold, and joins by shuffle (skewed keys split) when not; codes
    and metadata are the same. A null value gets a null code. The output column
    carries the ML metadata of a nominal attribute with its number of values.
    Returns the coded frame and the number of codes per output column.
    """
    coded, n_codes = df, {}
    for c, o in zip(input_cols, output_cols):
        codes = code_table(df, c, order)
        n_codes[o] = codes.count()
        nominal = {"ml_attr": {"type": "nominal", "name": o, "num_vals": n_codes[o]}}
        coded = coded.join(codes.select(c, F.col("code").alias(o)), c, "left").withColumn(o, F.col(o).alias(o, metadata=nominal))
    return coded, n_codes


def labels(df: DataFrame, input_col: str, max_labels: int, order: str = "frequencyDesc") -> list[str]:
    """The values in code order, like sklearn's ``classes_`` (M10); refuses more than ``max_labels``."""
    return [r[0] for r in collect_bounded(code_table(df, input_col, order).orderBy("code").select(input_col), max_labels)]


# ---- features and splits (M2, M3, M11) -------------------------------------

def assemble(df: DataFrame, inputs: Sequence[str], output_col: str = "features") -> DataFrame:
    """Dense feature vector column (M2)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output_col).transform(df)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42):
    """Seeded ``randomSplit`` (M3); reproducible for a fixed input layout."""
    return df.randomSplit(list(weights), seed=seed)


def hash_split(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.8,
               buckets: int = 10_000):
    """Split by an md5 of key columns: the same rows land on the same side on any cluster."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % buckets
    cut = int(buckets * train_fraction)
    return df.filter(h < cut), df.filter(h >= cut)


# ---- models (M4-M9, M14) ---------------------------------------------------

def regressors(label: str, features: str = "features", max_bins: int = 32,
               seed: int = 42) -> dict:
    """The four compared learners with default settings, seeded, ``maxBins`` set."""
    return {
        "linear_regression": LinearRegression(labelCol=label, featuresCol=features),
        "decision_tree": DecisionTreeRegressor(labelCol=label, featuresCol=features,
                                               maxBins=max_bins, seed=seed),
        "random_forest": RandomForestRegressor(labelCol=label, featuresCol=features,
                                               maxBins=max_bins, seed=seed),
        "gbt": GBTRegressor(labelCol=label, featuresCol=features, maxBins=max_bins,
                            seed=seed),
    }


def scores(predictions: DataFrame, label: str, prediction: str = "prediction") -> dict:
    """MAE, RMSE, MSE and R² (M5), plus the exact-match share.

    One aggregate pass computes all of them.
    """
    err = F.col(prediction) - F.col(label)
    row = predictions.agg(
        F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"),
        F.var_pop(label).alias("var"), F.count(F.lit(1)).alias("n"),
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("exact_share"),
    ).first()
    mse = row["mse"]
    return {
        "mae": row["mae"], "rmse": mse ** 0.5 if mse is not None else None, "mse": mse,
        "r2": 1 - mse / row["var"] if row["var"] else None,
        "exact_share": row["exact_share"], "n_test": row["n"],
    }


def evaluator_scores(predictions: DataFrame, label: str) -> dict:
    """The same metrics from ``RegressionEvaluator`` (the reference's API)."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(predictions) for m in METRICS}


def exact_accuracy(predictions: DataFrame, label: str) -> float:
    """The classification accuracy the original comparison printed."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="accuracy").evaluate(predictions)


def candidate_splits(rows: DataFrame, learner, values: Column) -> list[float]:
    """The thresholds that the tree ``learner``, fitted on ``rows``, may choose from for the numeric feature ``values``.

    Spark draws them from a seeded sample of the rows, whatever the label. A tree on this feature
    alone, with the feature as its own label, ends with one leaf for each bin, so it has used them all.
    """
    alone = assemble(rows.select(values.alias("_x")), ["_x"], "_alone")
    tree = DecisionTreeRegressor(labelCol="_x", featuresCol="_alone", maxBins=learner.getMaxBins(), maxDepth=30, seed=learner.getSeed()).fit(alone)
    return sorted({float(x) for x in re.findall(r"<= ([^)]+)\)", tree.toDebugString)})


def fits_cells(learner, rows: DataFrame, features: str) -> bool:
    """Whether ``learner`` finds the same model on weighted means of cells (see :func:`fit_on_cells`).

    Boosted trees on squared error do, unless rows are sampled, counted or have weights of their own. The features' metadata
    must tell numeric from nominal ones.
    """
    if not isinstance(learner, GBTRegressor):
        return False
    attrs = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return (bool(attrs) and set(attrs) <= {"numeric", "nominal"} and learner.getLossType() == "squared"
            and learner.getSubsamplingRate() == 1 and learner.getMinInstancesPerNode() == 1
            and not learner.isDefined("weightCol") and not learner.isDefined("validationIndicatorCol"))


def fit_on_cells(learner, rows: DataFrame, label: str, features: str, path: str):
    """``learner`` fitted on one weighted row for each cell of ``rows``, and the function that adds cells to a frame.

    A cell is a combination of bins of the numeric features (between candidate splits) and values of the nominal ones: all
    that a tree can tell apart. Rows of a cell share every leaf, so what their labels differ by adds the same to the
    error of every split, and leaves are means of labels either way. The cells' table is written to ``path``.
    """
    values = vector_to_array(F.col(features))
    cells, most = {}, learner.getMaxBins()
    for kind, attrs in rows.schema[features].metadata["ml_attr"]["attrs"].items():
        for a in attrs:
            x = F.get(values, F.lit(a["idx"]))
            if kind == "nominal":
                cells[a["idx"]] = x.alias(f"_cell{a['idx']}", metadata={"ml_attr": {"type": "nominal", **{k: v for k, v in a.items() if k != "idx"}}})
            else:
                splits = candidate_splits(rows, learner, x)
                most = max(most, len(splits) + 1)  # Spark may go slightly beyond maxBins
                bin_of = sum((F.when(x > t, 1.0).otherwise(0.0) for t in splits), F.lit(0.0))
                cells[a["idx"]] = bin_of.alias(f"_cell{a['idx']}", metadata={})
    names = [f"_cell{i}" for i in sorted(cells)]

    def celled(df: DataFrame) -> DataFrame:
        return assemble(df.select("*", *(cells[i] for i in sorted(cells))), names, "_cell").drop(*names)

    # A mean over a null label is null: the learner refuses it as it refuses the row.
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(label))
    means = celled(rows).groupBy("_cell").agg(mean.alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))
    means.write.parquet(path)
    means = rows.sparkSession.read.schema(means.schema).parquet(path)
    copies = -(-most // max(means.count(), 1))  # Spark allows no more bins than rows
    means = means.select("_cell", label, (F.col("_rows") / copies).alias("_rows"), F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return learner.copy({learner.weightCol: "_rows", learner.featuresCol: "_cell", learner.maxBins: most}).fit(means), celled


SCORE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("mae", T.DoubleType()), T.StructField("rmse", T.DoubleType()),
    T.StructField("mse", T.DoubleType()), T.StructField("r2", T.DoubleType()),
    T.StructField("exact_share", T.DoubleType()), T.StructField("n_test", T.LongType()),
])


def compare_models(spark: SparkSession, train: DataFrame, test: DataFrame, label: str,
                   features: str = "features", max_bins: int = 32, seed: int = 42,
                   models: Sequence[str] | None = None, learners: dict | None = None) -> DataFrame:
    """Fit each learner on ``train``, score on ``test``: one row per model (M9).

    Both are written once to the shared folder, which the iterative learners read: a lost
    executor costs its tasks, not a cache. Boosted trees, whose every round passes over their rows
    several times, are fitted on cells (see :func:`fit_on_cells`).
    ``learners`` (default :func:`regressors`) maps names to estimators.
    """
    ensure_checkpoint_dir(spark)  # GBT checkpoints its lineage every 10 rounds
    learners = learners or regressors(label, features, max_bins, seed)
    chosen = list(models) if models is not None else list(learners)
    paths = [scratch_path(spark, "comparison") for _ in range(2)]
    rows = []
    for df, path in zip((train, test), paths):
        df.write.parquet(path)
    train, test = (spark.read.schema(df.schema).parquet(path) for df, path in zip((train, test), paths))
    for name in chosen:
        if fits_cells(learners[name], train, features):
            paths.append(scratch_path(spark, "comparison"))
            model, celled = fit_on_cells(learners[name], train, label, features, paths[-1])
            s = scores(model.transform(celled(test)), label)
        else:
            s = scores(learners[name].fit(train).transform(test), label)
        rows.append((name, s["mae"], s["rmse"], s["mse"], s["r2"], s["exact_share"], s["n_test"]))
    for path in paths:
        delete_path(spark, path)
    return small_frame(spark, rows, SCORE_SCHEMA)


def cell_learners(label: str, features: str = "features") -> dict:
    """The compared learners without randomness: on nominal features of few values every tree
    learner reaches the mean of each combination, so scores have a closed form.
    """
    common = {"labelCol": label, "featuresCol": features}
    return {"linear_regression": LinearRegression(solver="normal", **common), "decision_tree": DecisionTreeRegressor(**common),
            "random_forest": RandomForestRegressor(numTrees=1, featureSubsetStrategy="all", bootstrap=False, **common),
            "gbt": GBTRegressor(maxIter=1, **common)}


def household_group_features(readings: DataFrame, label: str = ENERGY, keep: Sequence[str] = ()) -> DataFrame:
    """Codes of household and social group -> ``features``, energy -> ``label`` (§2.8).

    The household code is used as a number at every size (its metadata is dropped),
    so trees need no bin for each household; the group code stays nominal.
    """
    coded, _ = index_many(readings.select(*dict.fromkeys([HOUSEHOLD, GROUP, *keep]), F.col(ENERGY).alias(label)),
                          [HOUSEHOLD, GROUP], ["household_code", "group_code"])
    numeric = coded.withColumn("household_code", F.col("household_code").alias("household_code", metadata={}))
    return assemble(numeric, ["household_code", "group_code"]).select(
        "household_code", "group_code", "features", *keep, label)


def trees_on_group(readings: DataFrame, label: str = ENERGY) -> DataFrame:
    """M6-M8 on the social group alone: ``(model, group, prediction)``, one row for each."""
    coded, _ = index_many(readings.select(GROUP, label), [GROUP], ["group_code"])
    train = assemble(coded, ["group_code"])
    each = assemble(coded.select(GROUP, "group_code").distinct(), ["group_code"])
    common = {"labelCol": label, "featuresCol": "features", "maxDepth": 3}
    learners = {"decision_tree": DecisionTreeRegressor(**common),
                "random_forest": RandomForestRegressor(numTrees=1, featureSubsetStrategy="all", bootstrap=False, **common),
                "gbt": GBTRegressor(maxIter=1, **common)}
    parts = [m.fit(train).transform(each).select(F.lit(name).alias("model"), GROUP, "prediction") for name, m in learners.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def indexing_pipeline(label: str = ENERGY, max_bins: int = 32) -> Pipeline:
    """Indexers + assembler + tree in one ``Pipeline``."""
    return Pipeline(stages=[
        StringIndexer(inputCol=HOUSEHOLD, outputCol="household_code"),
        StringIndexer(inputCol=GROUP, outputCol="group_code"),
        VectorAssembler(inputCols=["household_code", "group_code"], outputCol="features"),
        DecisionTreeRegressor(labelCol=label, featuresCol="features", maxBins=max_bins),
    ])


def linear_fit(df: DataFrame, feature_cols: Sequence[str], label: str):
    """OLS (no regularisation) on the given columns (M4); returns the fitted model."""
    data = assemble(df.select(*feature_cols, label), feature_cols)
    return LinearRegression(labelCol=label, featuresCol="features", solver="normal").fit(data)


def label_encoded_regression(spark: SparkSession, readings: DataFrame,
                             columns: Sequence[str], label: str, order: Sequence[str],
                             fraction: float = 0.8) -> DataFrame:
    """M10 + M11 + M12: alphabetical codes, first 80 % in ``order`` to train, MAE on the rest."""
    names = [f"{c}_code" for c in columns]
    flagged = positional_flag(readings, order, fraction, "_train")
    coded, _ = index_many(flagged, list(columns), names, order="alphabetAsc")
    train, test = coded.filter("_train"), coded.filter("NOT _train")
    model = linear_fit(train, names, label)
    preds = model.transform(assemble(test.select(*names, label), names))
    s = scores(preds, label)
    return small_frame(spark, [("linear_regression", s["mae"], s["rmse"], s["mse"], s["r2"],
                                s["exact_share"], s["n_test"])], SCORE_SCHEMA)


def count_vectorize(df: DataFrame, text_col: str, vocab_size: int = 4, min_df: float = 1.0,
                    pattern: str = " "):
    """``split`` to an array, then count vectors (M13); returns (model, vectors).

    The vocabulary is the ``vocab_size`` most frequent tokens, ties in code-point order, that are in at least
    ``min_df`` rows (a share of the rows below 1). A null text has no tokens.
    """
    arr = df.withColumn("_tokens", F.coalesce(F.split(F.col(text_col), pattern), F.array().cast("array<string>")))
    terms = arr.select(F.explode("_tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if min_df != 1:
        least = min_df if min_df > 1 else min_df * df.count()
        rows = arr.select(F.explode(F.array_distinct("_tokens")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("rows"))
        terms = terms.join(rows.filter(F.col("rows") >= least), "term", "left_semi")
    vocabulary = [r.term for r in terms.orderBy(F.desc("n"), "term").limit(vocab_size).collect()]
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_tokens", outputCol="counts")
    return model, model.transform(arr).drop("_tokens")


def vocabulary_counts(model: CountVectorizerModel, vectors: DataFrame, col: str = "counts") -> DataFrame:
    """``(term_index, term, term_count)``: the model's vectors summed over all rows (as mean times weight, so rounded)."""
    total = vectors.agg(Summarizer.sum(vectors[col]).alias("total"))
    terms = F.array(*(F.lit(t) for t in model.vocabulary))
    return (total.select(F.posexplode(vector_to_array("total")).alias("term_index", "n"))
            .select("term_index", F.get(terms, F.col("term_index")).alias("term"), F.round("n").cast("long").alias("term_count")))


def classify_group(readings: DataFrame, value: str = ENERGY, group: str = GROUP) -> dict:
    """M15 as classification: multinomial logistic regression of the social group on energy.

    Returns ``shares`` (group, n, observed_share, fitted_share: the mean fitted probability), ``accuracy`` and
    ``log_loss`` over all rows. At the maximum of the likelihood fitted and observed shares are equal.
    """
    known = readings.select(group, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    coded, _ = index_many(known, [group], ["_code"])
    data = assemble(coded.filter("_code IS NOT NULL"), ["_x"])
    model = LogisticRegression(featuresCol="features", labelCol="_code", family="multinomial", maxIter=200, tol=1e-10).fit(data)
    p = vector_to_array("probability")
    scored = model.transform(data).select(group, "_code", "prediction", p.alias("p"))
    own = F.get("p", F.col("_code").cast("int"))
    totals = scored.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("_code")).cast("double")).alias("accuracy"),
                        F.avg(-F.log(own)).alias("log_loss"), F.array(*(F.avg(F.get("p", F.lit(i))) for i in range(model.numClasses))).alias("fitted"))
    found = totals.first()
    fitted = F.get(F.array(*(F.lit(x) for x in found["fitted"])), F.col("_code").cast("int"))
    shares = (scored.groupBy(group, "_code").agg(F.count(F.lit(1)).alias("n"))
              .select(group, "n", (F.col("n") / found["n"]).alias("observed_share"), fitted.alias("fitted_share")))
    return {"shares": shares, "accuracy": found["accuracy"], "log_loss": found["log_loss"]}


def persisted_pipeline(readings: DataFrame, path: str, label: str = ENERGY) -> PipelineModel:
    """Group indexer, assembler and tree fitted as one pipeline, saved to ``path`` and read back."""
    known = readings.select(GROUP, label).filter(F.col(GROUP).isNotNull() & F.col(label).isNotNull())
    stages = [StringIndexer(inputCol=GROUP, outputCol="group_code"), VectorAssembler(inputCols=["group_code"], outputCol="features"),
              DecisionTreeRegressor(labelCol=label, featuresCol="features")]
    Pipeline(stages=stages).fit(known).write().overwrite().save(path)
    return PipelineModel.load(path)
