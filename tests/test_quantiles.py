from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from hexcohort.operators.quantiles import exact_quantiles, medians


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(7)
    n = 3000
    return pd.DataFrame({
        "g": np.where(r.random(n) < 0.6, "big", np.where(r.random(n) < 0.5, "mid", "small")),
        "a": r.normal(0, 1, n), "hot": np.where(r.random(n) < 0.4, 7.0, r.exponential(100, n)),
        "wide": np.exp(r.normal(0, 12, n)), "gaps": np.where(r.random(n) < 0.2, np.nan, r.random(n))})


@pytest.mark.parametrize("one_pass,read,slots", [(200_000, 10_000, 64), (200, 20, 32), (0, 1, 4)])
def test_both_ways_agree_with_numpy(spark, data, one_pass, read, slots):
    df = spark.createDataFrame(data.replace({np.nan: None}), "g string, a double, hot double, wide double, gaps double")
    cols, probs = ["a", "hot", "wide", "gaps"], [0.0, 0.25, 0.5, 1.0]
    got = exact_quantiles(df, cols, probs, by=["g"], one_pass=one_pass, read_limit=read, slots=slots).toPandas()
    assert len(got) == 3 * len(cols) * len(probs)
    for r in got.itertuples():
        want = data.loc[data.g == r.g, r.feature].dropna().quantile(r.prob)
        assert np.isclose(r.value, want, rtol=1e-12), (r, want)


def test_whole_column_by_narrowing(spark, data):
    df = spark.createDataFrame(data[["a", "hot"]])
    got = medians(df, ["a", "hot"], one_pass=10, read_limit=5, slots=8)
    assert np.isclose(got["a"], data.a.median(), rtol=1e-12) and np.isclose(got["hot"], data.hot.median(), rtol=1e-12)


def test_empty_column_has_no_median(spark):
    assert medians(spark.createDataFrame([(None,)], "x double"), ["x"]) == {}


def test_infinities_and_wide_ranges_end(spark, monkeypatch):
    import hexcohort.operators.quantiles as Q

    rounds = []
    write = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name, *a: (rounds.append(name), write(df, name, *a))[1])
    r = np.random.default_rng(3)
    x = np.concatenate([np.exp(r.uniform(-100, 100, 5000)), [np.inf, np.inf, -np.inf, 0.0, -0.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {q["prob"]: q["value"] for q in exact_quantiles(df, ["x"], probs, one_pass=100, read_limit=20, slots=32).collect()}
    x.sort()
    for p in probs:
        at = (len(x) - 1) * p
        k = int(np.floor(at))
        want = x[k] if at == k else (k + 1 - at) * x[k] + (at - k) * x[k + 1]
        assert got[p] == pytest.approx(want, rel=1e-12)
    assert rounds.count("cuts") <= 8


def test_groups_with_null_keys_and_copies(spark):
    df = spark.createDataFrame([(None, 5.0)] * 300 + [("a", float(i)) for i in range(301)] + [("b", None)], "g string, x double")
    got = {(q["g"], q["prob"]): q["value"] for q in exact_quantiles(df, ["x"], [0.25, 0.5], by=["g"], one_pass=50, read_limit=10, slots=8).collect()}
    assert got == {(None, 0.25): 5.0, (None, 0.5): 5.0, ("a", 0.25): 75.0, ("a", 0.5): 150.0}
