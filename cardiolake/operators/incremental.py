"""Incremental load: content hashes, change detection, affected days.

Change detection is one left join of the current files with the import log
on ``(subject_id, file_name)``; both sides shuffle on that key once.
Re-aggregation is by *affected day*: a day's heart rate may span several
files, so every file that contributes to an affected day is re-read (a
file-wise merge would replace a day's value with a partial one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardiolake.functions.labels import file_category

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def with_hash(files: DataFrame, content: str = "content") -> DataFrame:
    """MD5 hex of the raw bytes."""
    return files.withColumn("hash_md5", F.md5(F.col(content)))


def with_category(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Category by the ordered file-name rules."""
    return files.withColumn("category", file_category(name))


def change_detection(files: DataFrame, log: DataFrame, keys=("subject_id", "file_name")) -> DataFrame:
    """Status new / changed / unchanged of each current file."""
    k = list(keys)
    cur = files if "hash_md5" in files.columns else with_hash(files)
    prev = log.select(*k, F.col("hash_md5").alias("_prev_hash"))
    j = cur.join(prev, k, "left")
    status = (F.when(F.col("_prev_hash").isNull(), F.lit(NEW))
              .when(F.col("_prev_hash") != F.col("hash_md5"), F.lit(CHANGED))
              .otherwise(F.lit(UNCHANGED)))
    return j.withColumn("status", status).drop("_prev_hash")


def change_preview(status: DataFrame) -> DataFrame:
    """Files per status and category (dry run)."""
    s = status if "category" in status.columns else with_category(status)
    return s.groupBy("status", "category").agg(F.count(F.lit(1)).alias("n_files"))


def changed_only(status: DataFrame) -> DataFrame:
    """New and changed files."""
    return status.where(F.col("status").isin(NEW, CHANGED))


def rows_of_affected_days(all_rows: DataFrame, days: DataFrame, keys=("subject_id", "day")) -> DataFrame:
    """All rows (from every file) of the affected days, for a full re-aggregation."""
    return all_rows.join(days, list(keys), "left_semi")


def new_log_entries(status: DataFrame, imported_at) -> DataFrame:
    """L14 source: log rows for new and changed files."""
    s = status if "category" in status.columns else with_category(status)
    return (changed_only(s).select("subject_id", "file_name", "hash_md5",
                                   F.lit(imported_at).cast("timestamp").alias("imported_at"),
                                   "category"))


def import_report(status: DataFrame, group=()) -> DataFrame:
    """Counts of new / changed / unchanged files and of new/changed files
    that fail to parse (``parse_error`` column, if present), per run or ``group``."""
    g = list(group)
    aggs = [F.count_if(F.col("status") == NEW).alias("n_new"),
            F.count_if(F.col("status") == CHANGED).alias("n_changed"),
            F.count_if(F.col("status") == UNCHANGED).alias("n_unchanged"),
            F.count(F.lit(1)).alias("n_files")]
    if "parse_error" in status.columns:
        aggs.append(F.count_if(F.col("status").isin(NEW, CHANGED) & F.col("parse_error").isNotNull())
                    .alias("n_errors"))
    return status.groupBy(*g).agg(*aggs)


def known_days_removed(rows: DataFrame, table: DataFrame, keys=("subject_id", "day")) -> DataFrame:
    """Drop rows of days already present in ``table``."""
    return rows.join(table.select(*keys), list(keys), "left_anti")
