import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cardiolake.operators import aggregate as AG, ranking as RK, stats as ST, topk as TK

D = dt.date


def _p(spark, rows):
    df = spark.createDataFrame(rows, "r double, n long")
    return [x.p for x in df.select(ST.r_p_value(F.col("r"), F.col("n")).alias("p")).collect()]


def test_p_value_against_t_table(spark):
    # two-sided p of r with n pairs; reference values from the t distribution
    p = _p(spark, [(0.5, 10), (0.632, 10), (-0.3, 50), (0.0, 20), (0.5, 2), (1.0, 9), (None, 9), (float("nan"), 9)])
    assert abs(p[0] - 0.141) < 1e-3 and abs(p[1] - 0.0499) < 1e-3 and abs(p[2] - 0.0343) < 1e-3
    assert p[3] == 1.0 and p[4] is None and p[5] == 0.0 and p[6] is None and p[7] is None


def _tail(r, n):
    """Student's t as a finite series in the angle whose sine is |r|."""
    nu, s, c = n - 2, abs(r), math.sqrt(1 - r * r)
    total, term = 0.0, 1.0 if nu % 2 == 0 else c
    for k in range(nu // 2):
        total += term
        term *= ((2 * k + 1) / (2 * k + 2) if nu % 2 == 0 else (2 * k + 2) / (2 * k + 3)) * c * c
    return 1 - (s * total if nu % 2 == 0 else 2 / math.pi * (math.asin(s) + s * total))


def test_p_value_equals_finite_series(spark):
    rows = [(r, n) for r in (0.001, 0.1, 0.3, -0.5, 0.9, 0.999) for n in (3, 4, 5, 6, 7, 10, 11, 50, 99, 1000, 20001)]
    for (r, n), p in zip(rows, _p(spark, rows), strict=True):
        assert abs(p - _tail(r, n)) < 1e-10, (r, n)
    tiny = _p(spark, [(0.9, 400)])[0]  # no cancellation far out in the tail
    assert 0 < tiny < 1e-140


def test_spread_spearman_and_quantiles_equal_whole_group_versions(spark):
    rng = np.random.default_rng(0)
    n = 3000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < .6, 0, rng.integers(1, 5, n)), "x": np.round(rng.normal(size=n), 2),
                        "y": np.where(rng.random(n) < .4, 7.0, rng.normal(size=n))})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.pmod(F.xxhash64("y", "x"), F.lit(50)) != 0, F.col("x")))
    d = df.toPandas().dropna()
    got = {x.g: (x.rho, x.n) for x in ST.spearman_spread(df, "x", "y", ("g",)).collect()}
    for g, part in d.groupby("g"):
        assert abs(part.x.rank().corr(part.y.rank()) - got[g][0]) < 1e-12 and got[g][1] == len(part)
    whole = ST.spearman_spread(df, "x", "y").collect()[0]
    assert abs(d.x.rank().corr(d.y.rank()) - whole.rho) < 1e-12
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for group in (("g",), ()):
        new = {tuple(r[c] for c in group): (r.quantiles, r.n) for r in RK.exact_quantiles(df, "x", qs, group, ranges=5).collect()}
        old = df.groupBy(*group).agg(F.percentile("x", F.array(*map(F.lit, qs))).alias("q"), F.count("x").alias("n"))
        assert new == {tuple(r[c] for c in group): (r.q, r.n) for r in old.collect()}


def test_ranks_of_one_value_one_row_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, 2.0, None)] * 7 + [(2, -0.0, 1.0), (2, 0.0, 1.0), (3, None, 1.0)], "g long, x double, y double")
    ranks = {(r.g, r.x): r["rank"] for r in RK.with_average_rank(df, "x", ("g",)).collect()}
    assert ranks == {(1, 2.0): 4.0, (2, 0.0): 1.5, (3, None): None}
    assert RK.exact_quantiles(df, "y", [0.5], ("g",)).where("g = 1").count() == 0
    empty = df.limit(0)
    assert RK.exact_quantiles(empty, "x", [0.5], ("g",)).count() == 0
    assert RK.with_row_rank(empty, [("x", True)]).count() == 0
    lone = ST.spearman_spread(df.where("g = 2"), "x", "y").collect()[0]
    assert lone.rho is None and lone.n == 2


def test_rows_are_numbered_over_ranges(spark):
    df = spark.range(0, 1000, numPartitions=7).select("id", (F.col("id") % 10).cast("double").alias("x"))
    got = RK.with_row_rank(df, [("x", True), ("id", False)], ranges=6).collect()
    want = sorted(range(1000), key=lambda i: (-(i % 10), i))
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))


def test_pearson_spearman_match_pandas(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, 200).astype(float)
    y = x * 0.5 + rng.normal(0, 3, 200).round(0)
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in zip(x, y)], "subject_id long, x double, y double")
    r = ST.correlation_report(df, "x", "y").collect()[0]
    pdf = pd.DataFrame({"x": x, "y": y})
    assert abs(r.r - pdf.x.corr(pdf.y)) < 1e-12
    assert abs(r.rho - pdf.x.rank().corr(pdf.y.rank())) < 1e-12
    slope, icpt = np.polyfit(x, y, 1)
    assert abs(r.slope - slope) < 1e-9 and abs(r.intercept - icpt) < 1e-9
    p = ST.with_p_values(ST.pearson(df, "x", "y")).collect()[0]
    assert p.p_value < 1e-6 and p.significant and p.effect in ("moderate", "strong")


def test_box_stats_and_histogram(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(0, D(2024, 1, i + 1), v) for i, v in enumerate(vals)],
                               "subject_id long, day date, v double")
    b = AG.box_stats(df, "v", "subject_id", "grp").collect()[0]
    assert (b.q1, b.median, b.q3, b.whisker_lo, b.whisker_hi, b.n_outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    h = {r.bin: r.n for r in AG.histogram(df, "v", 4).collect()}
    cnt, _ = np.histogram(vals, bins=4)
    assert [h.get(i, 0) for i in range(4)] == cnt.tolist()


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(50, 5, 101)
    df = spark.createDataFrame([(0, float(v), float(v) * 2) for v in a], "subject_id long, a double, b double")
    r = {x.col_name: x for x in AG.describe(df, ["a", "b"]).collect()}
    d = pd.Series(a).describe()
    assert r["a"]["count"] == 101 and abs(r["a"].mean - d["mean"]) < 1e-9 and abs(r["a"].std - d["std"]) < 1e-9
    assert abs(r["a"].p25 - d["25%"]) < 1e-9 and abs(r["a"].p75 - d["75%"]) < 1e-9


def test_top_k_plus_rest(spark):
    sports = ["A"] * 5 + ["B"] * 3 + ["C"] * 3 + ["D"] * 1
    df = spark.createDataFrame([(0, s, 2024) for s in sports], "subject_id long, sport string, year int")
    t = {r.sport: (r.n, r.rank) for r in TK.top_k_plus_rest(df, "sport", 2).collect()}
    assert t == {"A": (5, 1), "B": (3, 2), "Other": (4, 3)}
    t3 = TK.top_k_plus_rest(df, "sport", 4).collect()
    assert "Other" not in {r.sport for r in t3}
    keep = TK.restrict_to_top(df, "sport", 1).count()
    drop = TK.restrict_to_top(df, "sport", 1, keep=False).count()
    assert (keep, drop) == (5, 7)


def test_season_contrast(spark):
    rows = [(0, D(2024, 7, 1), 10.0), (0, D(2024, 7, 2), 20.0), (0, D(2024, 8, 1), 40.0), (0, D(2024, 1, 1), 5.0)]
    df = spark.createDataFrame(rows, "subject_id long, day date, v double")
    m = AG.season_contrast_of_monthly_means(df, "v").collect()[0]
    d = AG.season_contrast_of_days(df, "v").collect()[0]
    assert (m.summer, m.winter) == (27.5, 5.0)
    assert abs(d.summer - 70.0 / 3) < 1e-12


def test_approximate_quartiles_option(spark):
    rows = [(0, float(i)) for i in range(1001)]
    df = spark.createDataFrame(rows, "subject_id long, v double")
    r = AG.describe(df, ["v"], approx_accuracy=10000).collect()[0]
    assert abs(r.p50 - 500.0) <= 1.0 and abs(r.p25 - 250.0) <= 1.0
