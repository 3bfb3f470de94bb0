"""Property checks against plain-Python brute force on random small frames."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterwise.operators import clean
from meterwise.operators import consumption as C
from meterwise.operators import ml as ML
from meterwise.operators.wordcount import word_count

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cell = st.one_of(st.none(), st.sampled_from(["a", "b", "Null", ""]))
num = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32))
rows = st.lists(st.tuples(cell, num, cell), min_size=0, max_size=25)


@SETTINGS
@given(data=rows, how=st.sampled_from(["any", "all"]), thresh=st.one_of(st.none(), st.integers(0, 3)))
def test_drop_incomplete_is_na_drop(spark, data, how, thresh):
    df = spark.createDataFrame(data, "k string, v double, g string")
    mine = sorted(map(repr, clean.drop_incomplete(df, how=how, thresh=thresh).collect()))
    assert mine == sorted(map(repr, df.na.drop(how=how, thresh=thresh).collect()))


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["h1", "h2", "h3"]),
                               st.integers(0, 50).map(lambda x: x / 10)), max_size=40),
       k=st.integers(1, 10))
def test_top_k_is_python_sort(spark, data, k):
    df = spark.createDataFrame(data, "LCLid string, KWH_per_hh_per_30min double")
    got = [tuple(r) for r in C.top_k(df, k).collect()]
    expected = sorted(data, key=lambda r: (-r[1], r[0]))[:k]
    assert got == expected


@SETTINGS
@given(lines=st.lists(st.text(alphabet="ab é", max_size=12), max_size=8))
def test_word_count_is_counter(spark, lines):
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = {r.word: r["count"] for r in word_count(df).collect()}
    assert got == dict(Counter(w for l in lines for w in l.split(" ")))


def test_linear_scores_equal_numpy_least_squares(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 40, size=(300, 2)).astype(float)
    y = 0.3 + 0.02 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(0, 0.5, 300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)],
                               "a double, b double, y double")
    data = ML.assemble(df, ["a", "b"]).select("a", "b", "features", "y")
    train, test = ML.random_split(data, seed=3)
    tr = np.array([(r.a, r.b, r.y) for r in train.collect()])
    te = np.array([(r.a, r.b, r.y) for r in test.collect()])
    design = np.column_stack([np.ones(len(tr)), tr[:, :2]])
    beta = np.linalg.lstsq(design, tr[:, 2], rcond=None)[0]
    pred = np.column_stack([np.ones(len(te)), te[:, :2]]) @ beta
    err = pred - te[:, 2]
    row = ML.compare_models(spark, train.select("features", "y"), test.select("features", "y"), "y",
                            models=["linear_regression"]).first()
    assert row.mae == pytest.approx(np.abs(err).mean(), rel=1e-9)
    assert row.mse == pytest.approx((err ** 2).mean(), rel=1e-9)
    assert row.r2 == pytest.approx(1 - (err ** 2).mean() / te[:, 2].var(), rel=1e-9)
    assert row.n_test == len(te)
