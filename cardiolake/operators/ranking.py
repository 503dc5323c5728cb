"""Ranks and exact quantiles without a window over a whole group or table.

Values are counted first (combined map-side, so a value that a third of all
rows share is one row a task), the distinct values are dealt into value ranges
(``repartitionByRange``), and a range's place follows from the totals of the
ranges before it. A window never spans more than one group's values of one range,
whatever a group holds; the totals are one row per range and group.

The ranged table is written to the shared checkpoint folder, so that a lost
executor does not deal the values anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardiolake.session import ensure_checkpoint_dir


def ranges_of(spark: SparkSession) -> int:
    """How many value ranges: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/ranged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def skew_join(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join the few rows per key of ``small`` to ``rows``; keys compare null-safe, hot keys can be split.

    The extra join column makes both sides exchange for this join alone, the
    kind of join whose oversized partitions adaptive execution splits. It also
    carries the nulls: a null key is a value of its own.
    """
    mix = F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys])
    r = rows.withColumn("_mix", mix)
    s = small.withColumn("_mix_s", mix)
    on = F.col("_mix") == F.col("_mix_s")
    for k in keys:
        s = s.withColumnRenamed(k, f"_s_{k}")
        on = on & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return r.join(s, on, how).drop("_mix", "_mix_s", *[f"_s_{k}" for k in keys])


def ranged_counts(df: DataFrame, value: str, group=(), ranges: int | None = None, weight: str | None = None) -> DataFrame:
    """(group, value, c, _range): how often each value occurs, dealt into ascending ranges, stored.

    ``weight`` names a column that tells how many rows a row stands for.
    """
    g = list(group)
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*g, value).agg(times.alias("c"))
    dealt = counts.repartitionByRange(ranges or ranges_of(df.sparkSession), *g, value)
    return stored(dealt.withColumn("_range", F.spark_partition_id()))


def _range_offsets(ranged: DataFrame, g: list[str]) -> DataFrame:
    """(group, _range, before, total): rows of the group in the ranges before, and in all of them."""
    sums = ranged.groupBy(*g, "_range").agg(F.sum("c").alias("s"))
    w = Window.partitionBy(*g)  # one row per range
    before = F.sum("s").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(*g, "_range", F.coalesce(before, F.lit(0)).alias("before"), "s",
                       F.sum("s").over(w).alias("total"))


def _positions(ranged: DataFrame, offsets: DataFrame, value: str, g: list[str]) -> DataFrame:
    """``ranged`` with ``lo``, the rows of the group below the value."""
    w = Window.partitionBy(*g, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_in", F.coalesce(F.sum("c").over(w), F.lit(0)))
    return (skew_join(placed, offsets, [*g, "_range"])
            .withColumn("lo", F.col("before") + F.col("_in")).drop("_in", "before", "s"))


def average_ranks(df: DataFrame, value: str, group=(), name: str = "rank", ranges: int | None = None,
                  weight: str | None = None) -> DataFrame:
    """(group, value, ``name``): the rank of each distinct value in its group, ties averaged; no nulls."""
    g = list(group)
    ranged = ranged_counts(df, value, g, ranges, weight)
    return (_positions(ranged, _range_offsets(ranged, g), value, g)
            .select(*g, value, (F.col("lo") + (F.col("c") + 1) / 2.0).alias(name)))


def with_average_rank(df: DataFrame, value: str, group=(), name: str = "rank", ranges: int | None = None,
                      weight: str | None = None) -> DataFrame:
    """``df`` with the average rank of ``value`` in its group (null for a null value)."""
    ranks = average_ranks(df, value, group, name, ranges, weight)
    return skew_join(df, ranks, [*group, value], "left")


def exact_quantiles(df: DataFrame, value: str, qs: list[float], group=(), name: str = "quantiles",
                    ranges: int | None = None) -> DataFrame:
    """(group, ``name`` array, n): quantiles with linear interpolation, as ``percentile`` gives them.

    Selection in two steps: counts per value range tell which range holds a
    wanted rank, and only those ranges are looked at value by value. Groups
    without a non-null value are absent.
    """
    g = list(group)
    ranged = ranged_counts(df, value, g, ranges)
    offsets = _range_offsets(ranged, g)
    spots = [F.struct(F.lit(i).alias("i"), ((F.col("total") - 1) * F.lit(float(q))).alias("pos")) for i, q in enumerate(qs)]
    wanted = (offsets.select("*", F.explode(F.array(*spots)).alias("w"))
              .select(*g, "_range", "before", "s", "total", "w.i", "w.pos")
              # a rank between two rows needs both, which may lie in different ranges
              .where((F.floor("pos") < F.col("before") + F.col("s")) & (F.ceil("pos") >= F.col("before"))))
    hit = skew_join(ranged, wanted.select(*g, "_range").distinct(), [*g, "_range"])
    placed = _positions(hit, offsets, value, g)
    near = (skew_join(placed, wanted.select(*g, "_range", "i", "pos"), [*g, "_range"])
            .withColumn("hi", F.col("lo") + F.col("c") - 1)
            .where((F.col("lo") <= F.ceil("pos")) & (F.col("hi") >= F.floor("pos"))))
    v = F.col(value).cast("double")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (F.col("hi") >= rank), v))

    low, high = at(F.floor("pos")), at(F.ceil("pos"))
    pos = F.first("pos")
    one = F.when(F.floor(pos) == F.ceil(pos), low).otherwise((F.ceil(pos) - pos) * low + (pos - F.floor(pos)) * high)
    each = near.groupBy(*g, "i").agg(one.alias("q"), F.first("total").alias("n"))
    return (each.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("i", "q"))).alias("_s"), F.first("n").alias("n"))
            .select(*g, F.transform("_s", lambda x: x["q"]).alias(name), "n"))


def with_row_rank(df: DataFrame, order: list[tuple[str, bool]], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """``df`` with its rows numbered 1, 2, 3... by ``order`` = [(column, descending)], nulls last.

    Rows are dealt into ranges and sorted there; a row's number is its place in
    its range after the rows of the ranges before. The driver sees one total per
    range. Rows equal in all order columns get numbers in any order.
    """
    by = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    n = ranges or ranges_of(df.sparkSession)
    # the id counts up within a partition, with the partition's number in the bits from 33 up
    rows = stored(df.repartitionByRange(n, *by).sortWithinPartitions(*by)
                  .withColumn("_place", F.monotonically_increasing_id()))
    pid = F.shiftright("_place", 33)
    totals = {r["p"]: r["c"] for r in rows.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    before, offset = 0, []
    for p in range(max(totals, default=-1) + 1):
        offset.append(before)
        before += totals.get(p, 0)
    if not offset:
        return rows.drop("_place").withColumn(name, F.lit(None).cast("long"))
    starts = F.array(*[F.lit(x).cast("long") for x in offset])
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn(name, F.element_at(starts, (pid + 1).cast("int")) + within + 1).drop("_place")
