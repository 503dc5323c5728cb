"""End-to-end load of export files into the tables (the batch form of T01).

files -> hash + category -> change detection against the import log ->
parse new/changed files by category -> silver sample tables (partitioned
by day; only the day partitions a changed file touches are rewritten) ->
re-aggregate the *affected days* from silver -> upsert gold tables ->
import log written last (a crash before it re-imports; every step is an
idempotent upsert, so a re-run converges).

Each table write is a new version directory (see ``TableStore``); the change
set is persisted (memory and disk) because every category reads it; a lost
executor recomputes only its partitions from the files.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake import schemas as S
from cardiolake.operators import daily, extract as X, incremental as INC
from cardiolake.operators.upsert import TableStore, merge_plan
from cardiolake.operators.windows import best_per_key
from cardiolake.session import ensure_checkpoint_dir
from cardiolake.sources import json_docs as JD

ROW_TABLES = {  # category -> (table, schema, extractor, how its merge differs from the table's)
    # a file without sleep does not erase the sleep another source gave for the day
    "activity": ("activity", S.ACTIVITY_DOC, X.flatten_activity,
                 {"null_safe": True, "fill": ("sleep_hours", "sleep_quality")}),
    # a file gives all exercises of its session
    "training": ("training", S.TRAINING_DOC, X.explode_training, {"whole": ("subject_id", "start_ts")}),
    "fitness_test": ("fitness_tests", S.FITNESS_DOC, X.flatten_fitness, {}),
}
SAMPLE_TABLES = {  # category -> (silver table, schema, extractor)
    "heartrate": ("hr_samples", S.HR_DOC, X.explode_hr_samples),
    "hrv": ("ppi_samples", S.PPI_DOC, X.explode_ppi_samples),
}
DOC_SCHEMAS = {c: t[1] for c, t in (ROW_TABLES | SAMPLE_TABLES).items()}


class Ingest:
    """Load files ``(subject_id, file_name, content)`` into a ``TableStore``."""

    def __init__(self, spark: SparkSession, store: TableStore, imported_at: str | None = None):
        self.spark, self.store = spark, store
        self.imported_at = imported_at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        ensure_checkpoint_dir(spark)

    # -- steps -------------------------------------------------------------
    def detect(self, files: DataFrame) -> DataFrame:
        """One row per ``(subject_id, file_name)``: of entries that several archives repeat, the one
        of the newest archive that could be read (``modified_at``, then ``archive``; then the smallest
        hash). Rows with an ``error`` (damaged archives and entries) are files that cannot be parsed;
        their hash changes with the archive, so that a replaced one is tried again."""
        f = files
        for c, t in (("modified_at", "timestamp"), ("archive", "string"), ("error", "string")):
            if c not in files.columns:
                f = f.withColumn(c, F.lit(None).cast(t))
        f = INC.with_category(INC.with_hash(f.select("subject_id", "file_name", "content", "modified_at", "archive", "error")))
        f = f.withColumn("hash_md5", F.coalesce("hash_md5", F.md5(F.concat_ws("|", "archive", "modified_at", "error"))))
        f = best_per_key(f, ["subject_id", "file_name"],
                         [F.col("error").isNotNull(), F.col("modified_at").desc_nulls_last(),
                          F.col("archive").desc_nulls_last(), F.col("hash_md5")]).drop("modified_at")
        log = self.store.read("import_log", S.IMPORT_LOG)
        status = INC.change_detection(f, log)
        # bytes are kept of what this run loads
        status = status.withColumn("content", F.when(F.col("status") != INC.UNCHANGED, F.col("content")))
        # reused by every category below; recomputed from the files if an executor is lost
        return JD.with_parse_error(status, schemas=DOC_SCHEMAS).withColumn(
            "parse_error", F.when(F.col("status") != INC.UNCHANGED, F.coalesce("error", "parse_error"))
        ).persist(StorageLevel.MEMORY_AND_DISK)

    def silver_path(self, table: str) -> str:
        return f"{self.store.root}/silver/{table}"

    def read_silver(self, table: str, schema=None) -> DataFrame | None:
        return _read_if_exists(self.spark, self.silver_path(table), schema)

    def _replace_files(self, table: str, changed: DataFrame, rows: DataFrame) -> DataFrame:
        """Silver table, partitioned by ``day``: replace all rows of the changed files.

        Only day partitions touched by a changed file (before or after the
        change, from the small file->day index) are rewritten, with dynamic
        partition overwrite; the new content is staged with ``checkpoint()``
        (shared checkpoint dir) so no partition is overwritten while read.
        Returns the affected ``(subject_id, day)`` pairs.
        """
        keys = ["subject_id", "file_name"]
        index_table = f"{table}_files"
        old_index = self.store.read(index_table)
        new_index = rows.select("subject_id", "file_name", "day").distinct()
        touched_old = (old_index.join(changed.select(*keys), keys, "left_semi")
                       if old_index is not None else None)
        affected = new_index.select("subject_id", "day")
        if touched_old is not None:
            affected = affected.unionByName(touched_old.select("subject_id", "day"))
        affected = affected.distinct().checkpoint()
        days = affected.select("day").distinct()
        silver = self.read_silver(table, rows.schema)
        if silver is None:
            by_day(rows).write.mode("errorifexists").partitionBy("day").parquet(self.silver_path(table))
        else:
            # day partitions of affected days only (dynamic partition pruning on the join)
            keep = (silver.join(days, "day", "left_semi")
                    .join(changed.select(*keys), keys, "left_anti"))
            staged = by_day(keep.unionByName(rows.select(*keep.columns))).checkpoint()
            (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day").parquet(self.silver_path(table)))
            # days left without rows: the overwrite does not reach them (a calendar's days at most)
            empty = days.join(staged.select("day").distinct(), "day", "left_anti").collect()
            for r in empty:
                _delete(self.spark, f"{self.silver_path(table)}/day={r['day']}")
        # file -> day index: small (one row per file and day), rewritten as a new version
        kept_index = (old_index.join(changed.select(*keys), keys, "left_anti")
                      if old_index is not None else None)
        full_index = new_index if kept_index is None else kept_index.unionByName(new_index)
        full_index.write.mode("errorifexists").parquet(self.store.next_path(index_table))
        return affected

    def _merge_days(self, table: str, gold: DataFrame, days: DataFrame) -> dict[str, int]:
        """Merge re-aggregated days; affected days that have no row any more go."""
        gold, keys = gold.checkpoint(), ["subject_id", "day"]
        return self.store.merge_table(table, gold, remove=days.join(gold.select(*keys), keys, "left_anti"))

    def _reported(self, report: dict, began: float, archives: DataFrame) -> dict:
        """The run's counts and seconds, also appended to the table ``import_runs``, and those of
        each archive (null: files outside archives) to ``import_archives``."""
        report["seconds"] = round(time.monotonic() - began, 3)
        row = (self.imported_at, report["seconds"], *[report[k] for k in ("new", "changed", "unchanged", "errors")])
        names = ["imported_at", *S.IMPORT_RUNS.names[1:]]
        run = self.spark.createDataFrame([row], ", ".join(
            f"{n} {t}" for n, t in zip(names, ["string", "double"] + ["long"] * 4, strict=True)))
        (X.typed_projection(run, S.IMPORT_RUNS).write.mode("append")
         .parquet(f"{self.store.root}/import_runs/{self.store.BUCKETED}"))
        each = archives.select(F.lit(self.imported_at).alias("imported_at"), "archive",
                               F.lit(report["seconds"]).alias("seconds"),
                               *[F.col(f"n_{n}").alias(f"{n}_files") for n in ("new", "changed", "unchanged")],
                               F.col("n_errors").alias("errors"))
        (X.typed_projection(each, S.IMPORT_ARCHIVES).coalesce(1).write.mode("append")
         .parquet(f"{self.store.root}/import_archives/{self.store.BUCKETED}"))
        return report

    def run(self, files: DataFrame) -> dict:
        began = time.monotonic()
        st = self.detect(files)
        changed = INC.changed_only(st).where(F.col("parse_error").isNull())
        # a row per archive; not a cache, which Spark computes anew when the log it reads is written
        archives = INC.import_report(st, group=("archive",)).checkpoint()
        total = archives.agg(*[F.coalesce(F.sum(f"n_{n}"), F.lit(0)).alias(n)
                               for n in ("new", "changed", "unchanged", "errors")]).first()
        report = total.asDict()
        if report["new"] + report["changed"] == 0:
            st.unpersist()
            return self._reported(report, began, archives)
        # categories present in this run (at most a few dozen values)
        present = {r["category"] for r in changed.select("category").distinct().collect()}
        for cat, (table, schema, fn, how) in ROW_TABLES.items():
            if cat not in present:
                continue
            docs = JD.good(JD.parse_documents(changed.where(F.col("category") == cat), schema))
            rows = fn(docs)
            if table == "training":
                rows = rows.drop("file_name")
            report[table] = self.store.merge_table(table, X.typed_projection(rows, _schema_of(table)), **how)
        for cat, (table, schema, fn) in SAMPLE_TABLES.items():
            if cat not in present:
                continue
            docs = JD.good(JD.parse_documents(changed.where(F.col("category") == cat), schema))
            samples = fn(docs)
            days = self._replace_files(table, changed.where(F.col("category") == cat), samples)
            silver = self.read_silver(table, samples.schema)
            affected = INC.rows_of_affected_days(silver.select(*samples.columns), days)
            if table == "hr_samples":
                gold = daily.daily_hr(affected)
                report["heartrate"] = self._merge_days("heartrate", gold, days)
            else:
                gold = daily.daily_hrv(affected, order=("file_name", "entry", "device", "pos"),
                                       chunk=X.ppi_chunk())
                report["hrv"] = self._merge_days("hrv", gold, days)
        known = list(ROW_TABLES) + list(SAMPLE_TABLES)
        if present - set(known):
            other = changed.where(~F.col("category").isin(*known))
            docs = X.keep_document(other.withColumn("text", JD.decode_text("content")))
            report["raw_documents"] = self.store.merge_table(
                "raw_documents", X.typed_projection(docs, S.RAW_DOCUMENTS))
        # files that could not be loaded, with the reason; those that now could leave the quarantine
        keys = ["subject_id", "file_name"]
        if report["errors"] or self.store.current_path("quarantine"):
            bad = INC.changed_only(st).where(F.col("parse_error").isNotNull()).withColumn(
                "imported_at", F.lit(self.imported_at))
            report["quarantine"] = self.store.upsert(
                "quarantine", X.typed_projection(bad, S.QUARANTINE), keys, remove=changed.select(*keys))
        # every new/changed file is logged, unparseable ones too (they are counted as errors)
        log_rows = INC.new_log_entries(INC.changed_only(st), self.imported_at)
        report["import_log"] = self.store.merge_table("import_log", X.typed_projection(log_rows, S.IMPORT_LOG))
        report = self._reported(report, began, archives)
        st.unpersist()
        return report


#: Files of a day partition.
DAY_FILES = 16


def by_day(rows: DataFrame) -> DataFrame:
    """Rows dealt so that a day is written by few tasks (else by all of them, a file each)."""
    return rows.repartition(F.col("day"), F.pmod(F.xxhash64("subject_id"), F.lit(DAY_FILES)))


def _delete(spark: SparkSession, path: str) -> None:
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hp, True)


def _read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    jvm = spark._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _schema_of(table: str):
    return S.TABLES[table][0]
