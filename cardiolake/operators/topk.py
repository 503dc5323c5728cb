"""Top-k, top-k plus rest, semi/anti joins against the top list.

Counting is a hash aggregate; ranking runs over the *counts* (one row per
subject and label), never over the raw rows. Ties rank by label so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

OTHER = "Other"


def ranked_counts(df: DataFrame, label: str, group=("subject_id",), weight: str | None = None) -> DataFrame:
    """Labels by frequency; ``weight`` names a column that tells how many rows a row stands for."""
    g = list(group)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    c = df.where(F.col(label).isNotNull()).groupBy(*g, label).agg(n.alias("n"))
    w = Window.partitionBy(*g).orderBy(F.desc("n"), F.asc(label))
    return c.withColumn("rank", F.row_number().over(w))


def top_k(df: DataFrame, label: str, k: int, group=("subject_id",)) -> DataFrame:
    """The k most frequent labels per subject."""
    return ranked_counts(df, label, group).where(F.col("rank") <= k)


def top_k_plus_rest(df: DataFrame, label: str, k: int, group=("subject_id",),
                    other: str = OTHER) -> DataFrame:
    """Top k labels + one ``other`` row with the remainder (only if > 0), with shares."""
    g = list(group)
    r = ranked_counts(df, label, g)
    lab = F.when(F.col("rank") <= k, F.col(label)).otherwise(F.lit(other))
    rk = F.when(F.col("rank") <= k, F.col("rank")).otherwise(F.lit(k + 1))
    agg = r.groupBy(*g, lab.alias(label), rk.alias("rank")).agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*g))
    return agg.withColumn("share", share)


def restrict_to_top(df: DataFrame, label: str, k: int, group=("subject_id",), keep: bool = True) -> DataFrame:
    """Rows whose label is (``left_semi``) or is not (``left_anti``) in the top k."""
    g = list(group)
    top = top_k(df, label, k, g).select(*g, label)
    return df.join(top, g + [label], "left_semi" if keep else "left_anti")


def counts_per_year_top(df: DataFrame, label: str, k: int, group=("subject_id",),
                        other: str = OTHER) -> DataFrame:
    """Rows per year for each top-k label, the rest as ``other``.

    Rows are counted by year and label once; ranking and joining run over those counts.
    """
    g = list(group)
    c = df.groupBy(*g, "year", label).agg(F.count(F.lit(1)).alias("n"))
    top = _top_of(c, label, k, g)
    lab = F.when(F.col("rank").isNotNull(), F.col(label)).otherwise(F.lit(other))
    return c.join(top, g + [label], "left").groupBy(*g, "year", lab.alias(label)).agg(F.sum("n").alias("n"))


def _top_of(counts: DataFrame, label: str, k: int, g: list[str]) -> DataFrame:
    return ranked_counts(counts, label, g, weight="n").where(F.col("rank") <= k).select(*g, label, "rank")


def hours_year_top(df: DataFrame, label: str, k: int, value: str = "duration_min",
                   group=("subject_id",)) -> DataFrame:
    """Hours per year for the top-k labels, one column per rank
    (fixed pivot values 1..k, 0 when none), plus the label of each rank."""
    g = list(group)
    c = df.groupBy(*g, "year", label).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("_v"))
    j = c.join(_top_of(c, label, k, g), g + [label])
    p = (j.groupBy(*g, "year").pivot("rank", list(range(1, k + 1)))
         .agg(F.sum("_v") / 60.0))
    for i in range(1, k + 1):
        p = p.withColumn(str(i), F.coalesce(F.col(str(i)), F.lit(0.0))).withColumnRenamed(str(i), f"top{i}_hours")
    return p


def preview(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (a limit is the feature here)."""
    return (df.orderBy(*order) if order else df).limit(n)


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of the given columns (e.g. the years present)."""
    return df.select(*cols).distinct()
