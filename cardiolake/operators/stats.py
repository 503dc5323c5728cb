"""Correlation and regression per subject.

Pearson r, slope, intercept and R^2 are built-in aggregates (partial
aggregation, no sort). Spearman ranks a subject's daily or weekly series in a
window, and series of any size by counting values (``operators.ranking``). The
two-sided p-value is a native expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from cardiolake.functions.labels import effect_label
from cardiolake.operators.ranking import with_average_rank
from cardiolake.operators.windows import average_rank


def pearson(df: DataFrame, x: str, y: str, group=("subject_id",)) -> DataFrame:
    """A36 + A38: n, r, R^2, slope and intercept of y ~ x (rows with both values)."""
    g = list(group)
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def spearman(df: DataFrame, x: str, y: str, group=("subject_id",), tie_digits: int | None = 9) -> DataFrame:
    """Pearson r of the average ranks, for groups bounded by the calendar (one window per group).

    Values are ranked after rounding to ``tie_digits`` so that equal values
    computed along different float paths still tie. ``spearman_spread`` is for
    groups of any size.
    """
    g = list(group)
    d = _tied(df, x, y, g, tie_digits)
    r = d.select(*g, average_rank(x, g).alias("_rx"), average_rank(y, g).alias("_ry"))
    return r.groupBy(*g).agg(F.corr("_rx", "_ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def spearman_spread(df: DataFrame, x: str, y: str, group=(), tie_digits: int | None = 9,
                    ranges: int | None = None) -> DataFrame:
    """A37 over groups of any size (``group=()``: over all subjects and rows): rho and the number of pairs.

    Ranks come from counts by value range (``operators.ranking``): no window spans a
    group, and a value that most rows share is one row per task.
    """
    g = list(group)
    # equal pairs travel as one row with their number
    pairs = _tied(df, x, y, g, tie_digits).groupBy(*g, x, y).agg(F.count(F.lit(1)).alias("_n"))
    ranked = _ranked(_ranked(pairs, x, "_rx", g, ranges), y, "_ry", g, ranges)
    n, rx, ry, total = F.col("_n"), F.col("_rx"), F.col("_ry"), F.sum("_n")
    middle = total * ((total + 1) / 2.0) * ((total + 1) / 2.0)  # the mean rank is (n + 1) / 2, with ties too
    return (ranked.groupBy(*g).agg((F.sum(n * rx * ry) - middle).alias("xy"), (F.sum(n * rx * rx) - middle).alias("xx"),
                                   (F.sum(n * ry * ry) - middle).alias("yy"), total.alias("n"))
            .select(*g, F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"), "n"))


def _tied(df: DataFrame, x: str, y: str, g: list[str], digits: int | None) -> DataFrame:
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if digits is None:
        return d.select(*g, x, y)
    return d.select(*g, F.round(x, digits).alias(x), F.round(y, digits).alias(y))


def _ranked(pairs: DataFrame, value: str, name: str, g: list[str], ranges: int | None) -> DataFrame:
    """``pairs`` (with their number ``_n``) and the average rank of ``value``."""
    return with_average_rank(pairs, value, g, name, ranges, weight="_n")


def correlation_report(df: DataFrame, x: str, y: str, group=("subject_id",)) -> DataFrame:
    """Pearson and Spearman with their p-values, and the fitted line."""
    g = list(group)
    rho = spearman(df, x, y, g).select(*g, "rho", r_p_value(F.col("rho"), F.col("n")).alias("rho_p_value"))
    return pearson(df, x, y, g).withColumn("r_p_value", r_p_value(F.col("r"), F.col("n"))).join(rho, g, "left")


def fit_line(stats: DataFrame, lo: str, hi: str, points: int = 100, group=("subject_id",)) -> DataFrame:
    """``points`` evenly spaced x in [lo, hi] with the fitted y (per subject)."""
    g = list(group)
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    s = stats.select(*g, "slope", "intercept", lo, hi, i)
    x = F.col(lo) + (F.col(hi) - F.col(lo)) * F.col("i") / (points - 1)
    return s.select(*g, "i", x.alias("x"), (F.col("slope") * x + F.col("intercept")).alias("y"))


# -- U02: p-value of r (Student t with n-2 degrees of freedom) ---------------

#: Gauss-Legendre nodes and weights of 16 points, in four panels over [0, 1].
_X, _W = np.polynomial.legendre.leggauss(16)
_NODES = [(float((k + (1 + x) / 2) / 4), float(w / 8)) for k in range(4) for x, w in zip(_X, _W, strict=True)]


def _cosine_tail(theta: Column, df: Column) -> Column:
    """Integral of cos(u)^(df - 1) from ``theta`` to pi/2, ``theta`` in [0, pi/2).

    Beyond the integration width the integrand is below 1e-17 of its value at
    ``theta``: it falls like a Gaussian of variance 1/(df-1), and at the rate
    (df-1) tan(theta).
    """
    power = df - 1.0
    width = F.least(F.lit(float(np.pi / 2)) - theta, 9.0 / F.sqrt(F.greatest(power, F.lit(1e-9))),
                    40.0 / F.greatest(power * F.tan(theta), F.lit(1e-9)))
    nodes = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in _NODES])
    log_cos = F.log(F.cos(theta))
    inner = F.aggregate(nodes, F.lit(0.0), lambda acc, p: acc + p["w"] * F.exp(
        power * (F.log(F.cos(theta + width * p["x"])) - log_cos)))
    return F.exp(power * log_cos) * width * inner


def r_p_value(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation ``r`` of ``n`` pairs, null below three pairs.

    With t = r sqrt(df / (1 - r^2)) and t = sqrt(df) tan(theta), so that
    sin(theta) = |r|, the tail of Student's t is the integral of cos^(df-1) from
    theta over the one from 0: no gamma function and no Python.
    """
    df = (n - 2).cast("double")
    theta = F.asin(F.least(F.abs(r), F.lit(1.0)))
    p = F.least(F.lit(1.0), _cosine_tail(theta, df) / _cosine_tail(F.lit(0.0), df))
    return F.when(r.isNull() | F.isnan(r) | (n < 3), F.lit(None).cast("double")).when(
        F.abs(r) >= 1.0, F.lit(0.0)).otherwise(p)


def with_p_values(stats: DataFrame, r: str = "r", n: str = "n", alpha: float = 0.05) -> DataFrame:
    """Add p, significance and the effect label (F16) to a one-row-per-subject frame."""
    return (stats.withColumn("p_value", r_p_value(F.col(r), F.col(n)))
            .withColumn("significant", F.col("p_value") < alpha)
            .withColumn("effect", effect_label(F.col(r))))
