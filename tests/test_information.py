"""Mutual information by neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from hexcohort.operators.information import digamma, neighbour_information


def psi(n):
    return sum(1 / i for i in range(1, int(n))) - 0.5772156649015329


def plain(x, y, k):
    keep = np.isfinite(x) & pd.notna(y)
    x, y = x[keep], y[keep]
    keep = np.array([(y == v).sum() > 1 for v in y], bool)
    x, y = x[keep], y[keep]
    terms = []
    for i in range(len(x)):
        others = np.delete(np.abs(x - x[i])[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i))
        ki = min(k, len(others))
        d = np.sort(others)[ki - 1]
        m = ((x > x[i] - d) & (x < x[i] + d)).sum() if d else (x == x[i]).sum()
        terms.append(psi(ki) - psi(len(others) + 1) - psi(m))
    return max(0.0, psi(len(x)) + np.mean(terms))


@pytest.mark.parametrize("k,chunk", [(3, 1 << 16), (3, 11), (7, 16)])
def test_matches_all_pairs(spark, k, chunk):
    r = np.random.default_rng(k)
    n = 240
    y = np.concatenate([["hot"] * 80, r.choice(["a", "b", "c"], n - 83), ["one", "d", "d"]])
    pdf = pd.DataFrame({"y": y, "far": r.normal(0, 1, n) + 3 * (y == "a"), "step": r.integers(0, 6, n).astype(float), "flat": 2.0, "even": r.random(n)})
    pdf.loc[5, "far"], pdf.loc[6, "far"], pdf.loc[7, "y"] = None, np.inf, None
    got = {q.feature: q.mi for q in neighbour_information(spark.createDataFrame(pdf).repartition(5), ["far", "step", "flat", "even"], "y", k, chunk).collect()}
    for c in ("far", "step", "flat", "even"):
        assert abs(got[c] - plain(pdf[c].to_numpy(), pdf.y.to_numpy(), k)) < 1e-9


def test_digamma_and_empty(spark):
    from pyspark.sql import functions as F
    for q in spark.range(1, 4000, 7).select("id", digamma(F.col("id")).alias("p")).collect():
        assert abs(q.p - psi(q.id)) < 1e-12
    none = spark.createDataFrame([], "y string, a double")
    assert neighbour_information(none, ["a"], "y").collect() == []
    assert neighbour_information(spark.createDataFrame([("u", 1.0), ("v", 2.0)], "y string, a double"), ["a"], "y").collect() == []
