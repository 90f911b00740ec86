"""Trends of any degree against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmart.operators import trend


def points(spark, by):
    return spark.createDataFrame([(s, float(x), y) for s, xy in by.items() for x, y in xy], "series string, x double, y double").repartition(4)


@pytest.mark.parametrize("degree", [0, 3, 5, 8])
def test_fit_quality_and_forecast_equal_numpy(spark, degree):
    rng = random.Random(degree)
    by = {"a": [(x, rng.uniform(-5, 5) + x ** 2 / 50) for x in range(60)], "b": [(x / 7 + 300, rng.uniform(0, 9)) for x in range(31)],
          None: [(x, float(x ** 3 - x)) for x in range(12)]}
    pts = points(spark, by | {"a": by["a"] + [(4, None)]})
    cf = trend.fit(pts, degree=degree)
    fits = {s: np.polynomial.Polynomial.fit(*zip(*xy), degree) for s, xy in by.items()}
    for r in cf.collect():
        f, x = fits[r.series], np.array([x for x, _ in by[r.series]])
        assert r.n == len(x) and len(r.coef) == degree + 1
        if r.series != "b":  # powers of x near 300 lose digits, the recurrence does not
            assert np.allclose(np.polynomial.polynomial.polyval(x, r.coef), f(x), rtol=1e-6, atol=1e-4)
    q = {r.series: r for r in trend.quality(pts.where("y is not null and series is not null"), cf).collect()}
    for s in ("a", "b"):
        x, y = map(np.array, zip(*by[s]))
        res = y - fits[s](x)
        assert q[s].r2 == pytest.approx(1 - (res ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-9)
        assert q[s].rmse == pytest.approx(np.sqrt((res ** 2).mean())) and q[s].mae == pytest.approx(np.abs(res).mean())
    for r in trend.forecast(cf, F.lit("2026-01-01").cast("date"), horizon=2).collect():
        assert r.forecast == pytest.approx(fits[r.series](r.x), rel=1e-6, abs=1e-6)
    low = {r.series: r.coef for r in trend.lower_degree(cf, degree // 2).collect()}
    x, y = map(np.array, zip(*by["a"]))
    assert np.allclose(low["a"], np.polynomial.polynomial.polyfit(x, y, degree // 2), rtol=1e-6, atol=1e-8)


def test_few_points_ties_and_no_points(spark):
    pts = points(spark, {"line": [(0, 1.0), (1, 3.0)], "one": [(5, 2.0), (5, 4.0)], "flat": [(x, 7.0) for x in range(6)]})
    cf = trend.fit(pts, degree=4)
    got = {r.series: r.coef for r in cf.collect()}
    assert np.allclose(got["line"], [1, 2, 0, 0, 0]) and np.allclose(got["one"], [3, 0, 0, 0, 0]) and np.allclose(got["flat"], [7, 0, 0, 0, 0])
    assert {r.series: r.r2 for r in trend.quality(pts, cf).collect()}["flat"] == 0.0
    assert trend.fit(pts.limit(0), degree=3).count() == 0
    with pytest.raises(ValueError):
        trend.fit(pts, degree=-1)
