"""Daily metrics from raw samples: heart rate (A01) and pulse-interval HRV.

Scale notes
-----------
* ``daily_hr`` is a plain hash aggregate. ``percentile`` keeps a value->count
  map per group that is merged map-side, and heart rates are small integers,
  so even a subject-day holding a third of all samples costs a few hundred
  map entries per task, not one task holding the day.
* Successive differences (RMSSD) need the samples in order. A window over a
  whole subject-day would put a hot day into one task, so the order is cut
  into *chunks* (default: one minute of ``ts``). Differences inside a chunk
  come from a window over ``(group, chunk)``; the differences across chunk
  borders come from the first/last sample of each chunk, ordered over the
  chunk rows of a day (at most 1440 minutes; order-key chunks use several
  levels of chunks instead). The sum of squares is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardiolake.functions.convert import round_to


def daily_hr(samples: DataFrame, group=("subject_id", "day"), hr: str = "hr",
             quantile: float = 0.05, digits: int | None = 1) -> DataFrame:
    """Per subject-day: resting HR (5th percentile, linear), mean, max, calendar parts."""
    g = list(group)
    agg = samples.groupBy(*g).agg(
        F.percentile(F.col(hr), F.lit(quantile)).alias("resting_hr"),
        F.avg(hr).alias("hr_mean"),
        F.max(hr).cast("int").alias("hr_max"),
    )
    return agg.select(
        *g,
        round_to(F.col("resting_hr"), digits).alias("resting_hr"),
        round_to(F.col("hr_mean"), digits).alias("hr_mean"),
        "hr_max",
        F.weekday("day").alias("weekday_no"),
        F.month("day").alias("month"),
    )


def minute_chunk(ts: str = "ts", seconds: int = 60) -> Column:
    """Chunk id that grows with ``ts`` (monotone, so chunk order = sample order);
    ``seconds`` is 1, 60 or 3600."""
    unit = {1: "second", 60: "minute", 3600: "hour"}[seconds]
    return F.date_trunc(unit, F.col(ts))


def successive_diff_stats(samples: DataFrame, group: list[str], order: list[str],
                          chunk: Column | list[Column], value: str) -> DataFrame:
    """Per group: ``n``, mean, sample std, and sum/count of squared successive differences.

    ``order`` sorts samples inside a group. ``chunk`` is one chunk key or a
    list of ever coarser keys (each constant within the previous one, all
    non-decreasing in ``order``). Level 1 windows over one chunk; level k
    orders only the chunks of one level-k parent and adds the differences
    across their borders (first sample of a chunk minus last of the one
    before); the top level orders the top chunks of a group. With a time
    chunk (minutes of a day) one level suffices; order-key chunks get more
    levels so that no single window holds a growing number of rows.
    n, mean and std come from sums that the chunks carry along, so the samples
    are read once.
    """
    levels = chunk if isinstance(chunk, list) else [chunk]
    names = [f"_c{i}" for i in range(len(levels))]
    s = samples.select(*group, *order, F.col(value).cast("double").alias("_v"),
                       *[c.alias(n) for c, n in zip(levels, names)])
    keys = group + [names[0]]
    d = F.col("_v") - F.lag("_v").over(Window.partitionBy(*keys).orderBy(*order))
    ordkey = F.struct(*order)
    cur = (s.select(*group, *names, *order, "_v", d.alias("_d"))
           .groupBy(*group, *names)
           .agg(F.sum(F.col("_d") * F.col("_d")).alias("_ssd"), F.count("_d").alias("_nd"),
                F.count("_v").alias("_n"), F.sum("_v").alias("_s"), F.sum(F.col("_v") * F.col("_v")).alias("_ss"),
                F.min_by("_v", ordkey).alias("_first"), F.max_by("_v", ordkey).alias("_last")))
    for i in range(1, len(names) + 1):
        child, parents = names[i - 1], names[i:]
        part = group + parents[:1]
        border = F.col("_first") - F.lag("_last").over(Window.partitionBy(*part).orderBy(child))
        b = cur.select(*group, *parents, child, "_ssd", "_nd", "_n", "_s", "_ss", "_first", "_last", border.alias("_b"))
        cur = (b.groupBy(*group, *parents)
               .agg((F.coalesce(F.sum("_ssd"), F.lit(0.0))
                     + F.coalesce(F.sum(F.col("_b") * F.col("_b")), F.lit(0.0))).alias("_ssd"),
                    (F.sum("_nd") + F.count("_b")).alias("_nd"),
                    *[F.sum(c).alias(c) for c in ("_n", "_s", "_ss")],
                    F.min_by("_first", child).alias("_first"), F.max_by("_last", child).alias("_last")))
    n, total = F.col("_n"), F.col("_s")
    spread = F.greatest(F.lit(0.0), F.col("_ss") - total * total / n)
    return cur.select(*group, n.alias("n"), (total / n).alias("mean"),
                      F.when(n > 1, F.sqrt(spread / (n - 1))).alias("sd"), F.col("_ssd").alias("ssd"), F.col("_nd").alias("n_diff"))


def daily_hrv(samples: DataFrame, group=("subject_id", "day"), order=("ts", "event_id"),
              chunk: Column | list[Column] | None = None, ppi: str = "ppi", min_samples: int = 5,
              digits: int | None = 2, mean_digits: int | None = 1, hr_digits: int | None = 1,
              hr_from_rounded_mean: bool = False, hr_mean_digits: int | None = 1) -> DataFrame:
    """Per subject-day with at least ``min_samples``: RMSSD, SDNN, mean PPI, HR, n."""
    g, o = list(group), list(order)
    ch = chunk if chunk is not None else minute_chunk(o[0])
    st = successive_diff_stats(samples, g, o, ch, ppi).where(F.col("n") >= min_samples)
    mean = F.col("mean")
    hr_base = round_to(mean, hr_mean_digits) if hr_from_rounded_mean else mean
    return st.select(
        *g,
        # try_divide: filters on rmssd may be pushed where n_diff = 0 is still present
        round_to(F.sqrt(F.try_divide(F.col("ssd"), F.col("n_diff"))), digits).alias("rmssd"),
        round_to(F.col("sd"), digits).alias("sdnn"),
        round_to(mean, mean_digits).alias("ppi_mean_ms"),
        F.when(hr_base > 0, round_to(F.lit(60000.0) / hr_base, hr_digits)).alias("hr_from_ppi"),
        F.col("n").cast("long").alias("n_samples"),
    )


def daily_hrv_new_days(samples: DataFrame, group=("subject_id", "day"), order=("ts", "event_id"),
                       chunk: Column | list[Column] | None = None, ppi: str = "ppi",
                       known_days: DataFrame | None = None, digits: int | None = 2,
                       mean_digits: int | None = 1, hr_digits: int | None = 1,
                       hr_mean_digits: int | None = 1) -> DataFrame:
    """HRV on all samples of a day, HR from the rounded mean, skipping days
    already present in ``known_days`` (left anti join)."""
    g, o = list(group), list(order)
    if known_days is not None:
        samples = samples.join(known_days.select(*g).distinct(), g, "left_anti")
    return daily_hrv(samples, g, o, chunk, ppi, digits=digits, mean_digits=mean_digits,
                     hr_digits=hr_digits, hr_from_rounded_mean=True, hr_mean_digits=hr_mean_digits)
