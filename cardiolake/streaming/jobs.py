"""Streaming jobs.

* T01 ``file_stream``: new export files in a folder -> ``foreachBatch`` ->
  the same idempotent ``Ingest`` as the batch load. The stream checkpoint
  remembers which *paths* were seen; the import log still decides per entry
  (a new archive repeats old entries).
* T01 / L19 ``archive_stream``: ZIP archives by a seeking data source, with a
  journal of which archives were assigned, loaded and moved.
* T02 ``payload_stream``: landed API payloads -> extract -> upsert. Offsets
  are committed only after the merge succeeded (at-least-once + idempotent
  merge = effectively once).
* T03 ``daily_hr_stream``: per subject and day, resting HR (p5), mean, max
  on arriving samples; a day is emitted once the watermark passes its end,
  later samples of that day are dropped.

Checkpoints go to the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.operators.upsert import TableStore
from cardiolake.session import ensure_checkpoint_dir

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _ckpt(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def _subject_of(path, default: int):
    """Subject from a ``subject_id=<n>/`` directory of the path, else the default."""
    return F.coalesce(F.regexp_extract(path, r"subject_id=(\d+)/", 1).try_cast("long"), F.lit(default).cast("long"))


def file_stream(spark: SparkSession, folder: str, store: TableStore, name: str = "files",
                glob: str = "*.{json,zip}", default_subject: int = 0, imported_at: str | None = None,
                archive_dir: str | None = None):
    """Ingest every new JSON file and every entry of every new ZIP archive under ``folder``
    (availableNow run).

    L19: with ``archive_dir`` the source moves processed files there
    (``cleanSource=archive``); Spark does this lazily after later batches, so
    the import log, not the move, is what marks a file as processed.
    """
    from cardiolake.plans.ingest import Ingest
    from cardiolake.sources.archive import unzip_entries, wanted

    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    src = reader.load(folder)
    files = src.select(_subject_of(F.col("path"), default_subject).alias("subject_id"), "path", "modificationTime",
                       "content")
    reports = []

    def batch(df: DataFrame, epoch: int):
        zipped = F.lower("path").endswith(".zip")
        names = ["subject_id", "archive", "modified_at", "file_name", "content", "error"]
        plain = df.where(~zipped).select(
            "subject_id", F.lit(None).cast("string").alias("archive"), F.col("modificationTime").alias("modified_at"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "content",
            F.lit(None).cast("string").alias("error"))
        entries = wanted(unzip_entries(df.where(zipped), default_subject))
        reports.append(Ingest(spark, store, imported_at).run(plain.unionByName(entries.select(*names))))

    q = (files.writeStream.foreachBatch(batch).option("checkpointLocation", _ckpt(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return reports


def archive_stream(spark: SparkSession, folder: str, store: TableStore, journal: str, name: str = "archives",
                   archive_dir: str | None = None, default_subject: int = 0, imported_at: str | None = None,
                   part_bytes: int | None = None) -> list[dict]:
    """T01 + L19 for ZIP archives: load every archive under ``folder`` that ``journal`` does not know, and
    with ``archive_dir`` move it there (availableNow run; returns the reports of its batches).

    Order of steps: the batch's archives are written in the journal; tables and import log are merged;
    the journal notes *loaded*; files are moved; the journal notes *moved*. A run that dies before
    *loaded* is loaded again (merges are idempotent), one that dies later only moves what is left.
    """
    from cardiolake.plans.ingest import Ingest
    from cardiolake.sources import zip_source

    zip_source.register(spark)
    pages = zip_source.ArchiveJournal(journal)
    if archive_dir:
        pages.move(folder, archive_dir)  # what an earlier run left
    reader = (spark.readStream.format("export_zip").option("default_subject", default_subject)
              .option("journal", journal))
    if part_bytes:
        reader = reader.option("part_bytes", part_bytes)
    reports = []

    def batch(df: DataFrame, epoch: int):
        reports.append(Ingest(spark, store, imported_at).run(df))
        pages.loaded()
        if archive_dir:
            pages.move(folder, archive_dir)

    q = (reader.load(folder).writeStream.foreachBatch(batch).option("checkpointLocation", _ckpt(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return reports


def payload_stream(spark: SparkSession, root: str, endpoint: str, store: TableStore, name: str | None = None,
                   ingest_date: str = "1970-01-01", default_subject: int = 0):
    """Landed payloads of one endpoint -> rows -> upsert (availableNow run).

    Subjects come from ``subject_id=<n>/`` directories as in the batch read. A NULL of a
    payload never erases a value of another source: activity days and nights of sleep meet
    in one row of ``activity``, whichever comes first. Payloads without a readable day are kept in the
    table ``payload_quarantine`` and counted (``undated``)."""
    from cardiolake import schemas as S
    from cardiolake.operators import api_extract as AX
    from cardiolake.operators.extract import typed_projection
    from cardiolake.sources.api_payloads import ENDPOINT_SCHEMAS
    from cardiolake.sources.json_docs import once

    raw = (spark.readStream.format("text").option("wholetext", "true")
           .load(f"{root.rstrip('/')}/{endpoint}"))
    subject = _subject_of(F.col("_metadata.file_path"), default_subject)
    p = raw.select(subject.alias("subject_id"), F.col("value").alias("json_text"),
                   once(F.from_json("value", ENDPOINT_SCHEMAS[endpoint])).alias("p")).select(
        "subject_id", "json_text", "p.*")
    counts = []

    def batch(df: DataFrame, epoch: int):
        how = {}
        if endpoint in ("activity", "sleep"):
            rows, table = (AX.api_activity(df) if endpoint == "activity" else AX.api_sleep(df)), "activity"
            how = {"watched": None, "fill": tuple(S.ACTIVITY.names[2:])}
        elif endpoint == "exercise":
            rows = AX.api_exercise(df, with_start=True).withColumn("ordinal", F.lit(0))
            table, how = "training", {"fill": ("hr_avg", "hr_max", "distance_km")}
        elif endpoint == "physical_info":
            rows, table = AX.api_physical_info(df, ingest_date), "physical_info"
        elif endpoint == "nightly_recharge":
            rows, table = AX.api_recharge(df), "raw_documents"
        else:
            raise ValueError(f"no table for endpoint {endpoint}")
        report = store.merge_table(table, typed_projection(rows, S.TABLES[table][0]), **how)
        lost = AX.undated(df, endpoint).persist()
        report["undated"] = lost.count()
        if report["undated"]:
            store.upsert("payload_quarantine", lost, ["subject_id", "endpoint", "hash_md5", "reason"])
        lost.unpersist()
        counts.append(report)

    q = (p.writeStream.foreachBatch(batch).option("checkpointLocation", _ckpt(spark, name or endpoint))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return counts


def daily_hr_aggregate(samples: DataFrame, delay: str = "2 days", ts: str = "ts", hr: str = "hr",
                       quantile: float = 0.05) -> DataFrame:
    """Windowed daily HR with a watermark (streaming or batch input)."""
    s = samples.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    g = s.groupBy("subject_id", F.window("_ts", "1 day").alias("w"))
    return g.agg(F.percentile(F.col(hr), F.lit(quantile)).alias("resting_hr"),
                 F.avg(hr).alias("hr_mean"), F.max(hr).cast("int").alias("hr_max"),
                 F.count(F.lit(1)).alias("n_samples")) \
        .select("subject_id", F.to_date(F.col("w.start")).alias("day"), "resting_hr", "hr_mean",
                "hr_max", "n_samples")


def daily_hr_stream(spark: SparkSession, stream_samples: DataFrame, out_path: str, name: str = "daily_hr",
                    delay: str = "2 days") -> DataFrame:
    """Run T03 to completion (availableNow) into Parquet at ``out_path``; return the table."""
    agg = daily_hr_aggregate(stream_samples, delay)
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", _ckpt(spark, name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
