"""Daily heart rate from a stream whose samples come late and out of order.

Spark's watermark drops late rows silently and keeps the last days for ever open.
Here the open days are a table of counts per (subject, day, heart rate), so a day
is at most a few hundred narrow rows however many samples it has:

* ``state/epoch=n``  counts of the days open after batch ``n``
* ``marks/epoch=n``  the latest sample time seen (the horizon is ``delay`` before it)
* ``days/epoch=n``   counts of the days that batch ``n`` closed (their end passed the horizon)
* ``late/epoch=n``   counts of samples of days that were closed before

A batch reads what the batch before wrote and overwrites its own folders, the
mark last, so that a batch that runs again after a crash gives the same tables.
No sample is dropped: it is in ``state``, ``days`` or ``late``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.streaming.jobs import _ckpt

COUNTS = "subject_id long, day date, hr int, n long"


def _path(root: str, what: str, epoch: int | str) -> str:
    return f"{root}/{what}/epoch={epoch}"


def _exists(spark: SparkSession, path: str) -> bool:
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hp)


def _read(spark: SparkSession, root: str, what: str, epoch: int | str = "*") -> DataFrame:
    """Counts of one batch, or of all."""
    path = f"{root}/{what}" if epoch == "*" else _path(root, what, epoch)
    if not _exists(spark, path):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(path).select("subject_id", "day", "hr", "n")


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("subject_id", "day", "hr").agg(F.sum("n").alias("n"))


def run_batch(spark: SparkSession, samples: DataFrame, epoch: int, root: str, delay_days: int = 2) -> None:
    """One batch of samples (subject_id, ts, hr)."""
    mark = None
    if epoch > 0 and _exists(spark, _path(root, "marks", epoch - 1)):
        mark = spark.read.parquet(_path(root, "marks", epoch - 1)).first()["high"]
    new = samples.select("subject_id", F.to_date("ts").alias("day"), F.col("hr").cast("int").alias("hr"), "ts")
    new = new.where(F.col("day").isNotNull() & F.col("hr").isNotNull())
    counts = (new.groupBy("subject_id", "day", "hr").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("high"))
              .persist())
    highs = [h for h in (mark, counts.agg(F.max("high").alias("h")).first()["h"]) if h is not None]
    high = max(highs, default=None)

    def closed(at):
        """Days whose end lies at or before the horizon of a mark."""
        if at is None:
            return F.lit(False)
        return F.date_add("day", 1).cast("timestamp") <= F.lit(at) - F.expr(f"INTERVAL {delay_days} DAYS")

    counts_now = counts.drop("high")
    counts_now.where(closed(mark)).write.mode("overwrite").parquet(_path(root, "late", epoch))
    old = _read(spark, root, "state", epoch - 1) if epoch > 0 else spark.createDataFrame([], COUNTS)
    merged = _summed(old.unionByName(counts_now.where(~closed(mark)))).persist()
    merged.where(closed(high)).write.mode("overwrite").parquet(_path(root, "days", epoch))
    merged.where(~closed(high)).write.mode("overwrite").parquet(_path(root, "state", epoch))
    (spark.createDataFrame([(high,)], "high timestamp").coalesce(1)
     .write.mode("overwrite").parquet(_path(root, "marks", epoch)))
    merged.unpersist()
    counts.unpersist()
    if epoch > 1:  # the batch before this one may have to run from it again, the one before that not
        _delete(spark, _path(root, "state", epoch - 2))


def _delete(spark: SparkSession, path: str) -> None:
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hp, True)


def open_days_stream(spark: SparkSession, stream_samples: DataFrame, root: str, name: str = "open_days",
                     delay_days: int = 2) -> int:
    """Run all waiting batches (availableNow); the number of batches run."""
    done = []

    def batch(df: DataFrame, epoch: int):
        run_batch(spark, df, epoch, root, delay_days)
        done.append(epoch)

    q = (stream_samples.writeStream.foreachBatch(batch).option("checkpointLocation", _ckpt(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(done)


def _last(spark: SparkSession, root: str) -> int:
    if not _exists(spark, f"{root}/marks"):
        return -1
    found = spark.read.parquet(f"{root}/marks").agg(F.max("epoch").alias("e")).first()["e"]
    return -1 if found is None else int(found)


def daily_table(spark: SparkSession, root: str, with_open: bool = False, with_late: bool = False,
                quantile: float = 0.05) -> DataFrame:
    """subject_id, day, resting_hr, hr_mean, hr_max, n_samples of the closed days.

    ``with_open`` adds the open days (a closing run), ``with_late`` the late samples; with both the
    table is that of a batch over all samples.
    """
    counts = _read(spark, root, "days")
    if with_open:
        last = _last(spark, root)
        counts = counts.unionByName(_read(spark, root, "state", last)) if last >= 0 else counts
    if with_late:
        counts = counts.unionByName(_read(spark, root, "late"))
    c = _summed(counts)
    return c.groupBy("subject_id", "day").agg(
        F.percentile(F.col("hr"), F.lit(quantile), F.col("n")).alias("resting_hr"),
        (F.sum(F.col("hr") * F.col("n")) / F.sum("n")).alias("hr_mean"),
        F.max("hr").cast("int").alias("hr_max"), F.sum("n").alias("n_samples"))


def late_samples(spark: SparkSession, root: str) -> DataFrame:
    """subject_id, day, n_late: samples that came after their day was closed."""
    return (_read(spark, root, "late").groupBy("subject_id", "day").agg(F.sum("n").alias("n_late")))
