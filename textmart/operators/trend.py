"""Least-squares trends, fit quality and extrapolation per series.

A series is long form ``(series, x, y)`` with x = 0..n-1 (observation
index). Degree 1 uses ``regr_slope``/``regr_intercept``; degree 2 solves the
3x3 normal equations from power sums (Cramer's rule) in the same aggregate.
Every step is one grouped aggregate per series plus a join of the
(one-row-per-series) coefficients back to the points.

Higher degrees are fitted in polynomials that are orthogonal on the points of
each series: p0 = 1, p(k+1) = (z - a_k) p_k - b_k p(k-1) with z = x moved and
scaled to [-1, 1]. One aggregate a degree gives a_k, b_k and the coefficient
of p_k, so no system of equations is solved, a fit of degree d holds the fits
of all lower degrees, and nothing but a row per series is kept between steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.operators.joins import join_null_safe
from textmart.session import cut_lineage

#: A polynomial whose mean square on the points is below this vanishes there: the series has no more points to fit.
VANISHES = 1e-20


def index_series(df: DataFrame, *, series: str, date: str, value: str) -> DataFrame:
    """x = position of the date among all dates of the table (0-based), as in a wide date table."""
    dates = df.select(date).distinct()
    # one row per distinct date: the ordinal window runs over the calendar, not over data rows
    idx = dates.withColumn("x", (F.dense_rank().over(Window.orderBy(date)) - 1).cast("double"))
    return df.join(idx, on=date).select(series, date, "x", F.col(value).cast("double").alias("y"))


def _det3(a, b, c, d, e, f, g, h, i) -> Column:
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def fit(points: DataFrame, *, series: str = "series", degree: int = 1) -> DataFrame:
    """Coefficients ``c0, c1[, c2]`` per series (y = c0 + c1 x + c2 x^2), plus n and last x.

    Other degrees: see ``fit_orthogonal``.
    """
    x, y = F.col("x"), F.col("y")
    if degree == 1:
        return points.groupBy(series).agg(
            F.regr_intercept(y, x).alias("c0"), F.regr_slope(y, x).alias("c1"),
            F.lit(0.0).alias("c2"), F.count(y).alias("n"), F.max(x).alias("x_last"))
    if degree != 2:
        return fit_orthogonal(points, series=series, degree=degree)
    s = points.groupBy(series).agg(
        F.count(y).cast("double").alias("s0"), F.sum(x).alias("s1"), F.sum(x * x).alias("s2"),
        F.sum(F.pow(x, 3)).alias("s3"), F.sum(F.pow(x, 4)).alias("s4"),
        F.sum(y).alias("t0"), F.sum(x * y).alias("t1"), F.sum(x * x * y).alias("t2"),
        F.count(y).alias("n"), F.max(x).alias("x_last"))
    c = {k: F.col(k) for k in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")}
    det = _det3(c["s0"], c["s1"], c["s2"], c["s1"], c["s2"], c["s3"], c["s2"], c["s3"], c["s4"])
    d0 = _det3(c["t0"], c["s1"], c["s2"], c["t1"], c["s2"], c["s3"], c["t2"], c["s3"], c["s4"])
    d1 = _det3(c["s0"], c["t0"], c["s2"], c["s1"], c["t1"], c["s3"], c["s2"], c["t2"], c["s4"])
    d2 = _det3(c["s0"], c["s1"], c["t0"], c["s1"], c["s2"], c["t1"], c["s2"], c["s3"], c["t2"])
    return s.select(series, F.try_divide(d0, det).alias("c0"), F.try_divide(d1, det).alias("c1"),
                    F.try_divide(d2, det).alias("c2"), "n", "x_last")


def _polynomial(x: Column, *, value: bool) -> Column:
    """p_k(x) for the next k after the arrays ``a``, ``b``, or the fitted value at x (with ``c``)."""
    z = (x - F.col("mid")) / F.col("half")
    start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("q"), F.lit(0.0).alias("v"))
    rows = F.arrays_zip("a", "b", "c")
    end = F.aggregate(rows, start, lambda s, r: F.struct(((z - r["a"]) * s["p"] - r["b"] * s["q"]).alias("p"), s["p"].alias("q"),
                                                         (s["v"] + r["c"] * s["p"]).alias("v")))
    return end["v"] if value else end["p"]


def _power_coefficients(degree: int) -> Column:
    """Coefficients of 1, x, x^2, ... of the fitted polynomial."""
    doubles = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    none = doubles(*[0] * (degree + 1))
    start = F.struct(doubles(1, *[0] * degree).alias("p"), none.alias("q"), none.alias("v"))

    def step(s: Column, r: Column) -> Column:
        by_x = F.concat(doubles(0), F.slice(s["p"], 1, degree))
        moved = F.zip_with(by_x, s["p"], lambda u, p: u / F.col("half") - p * (F.col("mid") / F.col("half") + r["a"]))
        return F.struct(F.zip_with(moved, s["q"], lambda u, q: u - r["b"] * q).alias("p"), s["p"].alias("q"),
                        F.zip_with(s["v"], s["p"], lambda v, p: v + r["c"] * p).alias("v"))

    return F.aggregate(F.arrays_zip("a", "b", "c"), start, step)["v"]


def fit_orthogonal(points: DataFrame, *, series: str = "series", degree: int) -> DataFrame:
    """M14 for any degree: ``(series, coef, n, x_last, mid, half, a, b, c)``, ``coef`` the coefficients of 1, x, x^2, ...

    Points without x or y are left out; a series with fewer than ``degree + 1`` different x is fitted exactly by the degree
    it has points for, its higher coefficients are 0. A null series is a series.
    """
    if degree < 0:
        raise ValueError("degree must not be negative")
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    pts = cut_lineage(points.where(x.isNotNull() & y.isNotNull()).select(series, x.alias("x"), y.alias("y")))
    half = (F.max("x") - F.min("x")) / 2
    none = F.array().cast("array<double>")
    now = pts.groupBy(series).agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x_last"), ((F.max("x") + F.min("x")) / 2).alias("mid"),
                                  F.when(half > 0, half).otherwise(1.0).alias("half"))
    now = cut_lineage(now.withColumns({"a": none, "b": none, "c": none, "norm": F.lit(0.0)}))
    for k in range(degree + 1):
        p = _polynomial(F.col("x"), value=False)
        here = join_null_safe(pts, now, [series]).withColumn("p", p).withColumn("z", (F.col("x") - F.col("mid")) / F.col("half"))
        sums = here.groupBy(series).agg(F.sum(F.col("p") * F.col("p")).alias("_pp"), F.sum(F.col("z") * F.col("p") * F.col("p")).alias("_zpp"),
                                        F.sum(F.col("y") * F.col("p")).alias("_yp"))
        there = F.col("_pp") > VANISHES * F.col("n")
        value = lambda v: F.when(there, v).otherwise(0.0)  # noqa: B023, E731
        now = join_null_safe(now, sums, [series]).select(
            series, "n", "x_last", "mid", "half", F.array_append("a", value(F.try_divide("_zpp", "_pp"))).alias("a"),
            F.array_append("b", value(F.try_divide("_pp", "norm")) if k else F.lit(0.0)).alias("b"),
            F.array_append("c", value(F.try_divide("_yp", "_pp"))).alias("c"), value(F.col("_pp")).alias("norm"))
        now = cut_lineage(now)
    return now.select(series, _power_coefficients(degree).alias("coef"), "n", "x_last", "mid", "half", "a", "b", "c")


def lower_degree(coeffs: DataFrame, degree: int) -> DataFrame:
    """The fit of a lower degree that a fit of ``fit_orthogonal`` holds."""
    cut = coeffs.withColumns({k: F.slice(k, 1, degree + 1) for k in ("a", "b", "c")})
    return cut.withColumn("coef", _power_coefficients(degree))


def _parameters(coeffs: DataFrame) -> list[str]:
    return ["coef", "mid", "half", "a", "b", "c"] if "coef" in coeffs.columns else ["c0", "c1", "c2"]


def _trend(x: Column, coeffs: DataFrame) -> Column:
    if "coef" in coeffs.columns:
        return _polynomial(x, value=True)
    return F.col("c0") + F.col("c1") * x + F.col("c2") * x * x


def quality(points: DataFrame, coeffs: DataFrame, *, series: str = "series") -> DataFrame:
    """M15 + M18: R^2 (0 when the series is constant), RMSE, MAE, residual std, band, direction."""
    j = points.join(coeffs, on=series)
    mean_y = F.avg("y").over(Window.partitionBy(series))
    per = j.select(series, (F.col("y") - _trend(F.col("x"), coeffs)).alias("r"), (F.col("y") - mean_y).alias("dy"))
    q = per.groupBy(series).agg(
        F.sum(F.col("r") * F.col("r")).alias("ss_res"), F.sum(F.col("dy") * F.col("dy")).alias("ss_tot"),
        F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rmse"), F.avg(F.abs("r")).alias("mae"),
        F.stddev_pop("r").alias("std_resid")).join(coeffs, on=series)
    r2 = F.when(F.col("ss_tot") != 0, 1 - F.col("ss_res") / F.col("ss_tot")).otherwise(F.lit(0.0))
    t_first, t_last = _trend(F.lit(0.0), coeffs), _trend(F.col("x_last"), coeffs)
    shown = ["coef"] if "coef" in coeffs.columns else ["c0", "c1", "c2"]
    return q.select(series, *shown, r2.alias("r2"), "rmse", "mae", "std_resid",
                    (2 * F.col("std_resid")).alias("band"),
                    F.when(t_last > t_first, "rising").otherwise("falling").alias("direction"))


def forecast(coeffs: DataFrame, last_date: Column, *, series: str = "series", horizon: int = 7) -> DataFrame:
    """Values at x = n .. n+horizon-1 on the calendar days after ``last_date``."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    out = coeffs.select(series, *_parameters(coeffs), "x_last", F.explode(steps).alias("h"))
    x = F.col("x_last") + F.col("h")
    return out.select(series, F.date_add(last_date, F.col("h")).alias("date"), x.alias("x"),
                      _trend(x, coeffs).alias("forecast"))


def forecast_table(points: DataFrame, coeffs: DataFrame, *, series: str = "series", date: str = "date",
                   horizon: int = 7, digits: int = 2, band: bool = False) -> DataFrame:
    """Observed rows (fact, trend) followed by future rows (forecast), rounded to ``digits``.

    M18: with ``band`` the future rows carry ``low`` and ``high``, the forecast
    minus and plus twice the residual deviation.
    """
    last = points.select(F.max(date)).scalar()
    obs = points.join(coeffs, on=series).select(
        series, date, "x", F.col("y").alias("fact"), F.round(_trend(F.col("x"), coeffs), digits).alias("trend"),
        F.lit(None).cast("double").alias("forecast"))
    fut = forecast(coeffs, last, series=series, horizon=horizon).select(
        series, date, "x", F.lit(None).cast("double").alias("fact"), F.lit(None).cast("double").alias("trend"),
        F.round("forecast", digits).alias("forecast"), F.col("forecast").alias("_f"))
    if not band:
        return obs.unionByName(fut.drop("_f"))
    width = quality(points, coeffs, series=series).select(series, "band")
    fut = fut.join(width, on=series).withColumns({"low": F.round(F.col("_f") - F.col("band"), digits),
                                                  "high": F.round(F.col("_f") + F.col("band"), digits)}).drop("_f", "band")
    return obs.unionByName(fut, allowMissingColumns=True)
