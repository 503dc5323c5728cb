"""Export archives (ZIP) and unpacked folders as DataFrames of files.

``archive_source`` reads archives through the data source of ``zip_source``: many
tasks an archive, one entry in memory. For stores that only Spark's own readers
reach there is ``unzip_entries`` over ``binaryFile`` (``mapInPandas``, one archive
in memory per task; the entries are then spread over the cluster). In both a
damaged archive or entry is a row without content and with an ``error``.
"""

from __future__ import annotations

import sys

import io
import zipfile
import zlib

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.functions.labels import file_category
from cardiolake.sources import zip_source

# Python code of this module runs in Spark's Python workers; ship it with the
# task so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY_SCHEMA = "subject_id long, archive string, modified_at timestamp, file_name string, content binary, error string"
#: A batch of entries is passed on at so many entries or bytes.
BATCH_ENTRIES, BATCH_BYTES = 512, 32 << 20


def _subject_col(df: DataFrame, default_subject: int):
    # partition discovery: .../subject_id=<n>/export.zip
    if "subject_id" in df.columns:
        return F.col("subject_id").cast("long")
    return F.lit(default_subject).cast("long")


def archive_listing(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Waiting archives with size (MB) and mtime; the content is pruned."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select("path", F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"),
                     F.col("modificationTime").alias("modified_at"))


def _entries(path, content):
    """(file name, content, error) of an archive's entries."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, ValueError, EOFError) as bad:
        yield path.rsplit("/", 1)[-1], None, f"damaged_archive: {bad}"
        return
    with archive:
        for info in archive.infolist():
            if info.is_dir():
                continue
            if info.flag_bits & 1:
                yield info.filename, None, "encrypted_entry"
                continue
            try:
                yield info.filename, archive.read(info), None
            except (zipfile.BadZipFile, zlib.error, EOFError, ValueError, NotImplementedError, RuntimeError) as bad:
                yield info.filename, None, f"damaged_entry: {bad}"


def _unzip(batches):
    names = ["subject_id", "archive", "modified_at", "file_name", "content", "error"]
    for pdf in batches:
        out, held = [], 0
        for subject, path, modified, content in zip(pdf["subject_id"], pdf["path"], pdf["modified_at"], pdf["content"]):
            for name, data, error in _entries(path, content):
                out.append((int(subject), path, modified, name, data, error))
                held += len(data or b"")
                if len(out) >= BATCH_ENTRIES or held >= BATCH_BYTES:
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)


def unzip_entries(archives: DataFrame, default_subject: int = 0,
                  partitions: int | None = None) -> DataFrame:
    """Rows ``(path, modificationTime, content[, subject_id])`` of ZIP files -> one row
    per entry. An archive is one value of Spark's binary file source, which ends the job beyond 2 GiB:
    larger ones need ``archive_source`` or must be unpacked into a folder (``folder_source``)."""
    src = archives.select(_subject_col(archives, default_subject).alias("subject_id"), "path",
                          F.col("modificationTime").alias("modified_at"), "content")
    entries = src.mapInPandas(_unzip, ENTRY_SCHEMA)
    n = partitions or archives.sparkSession.sparkContext.defaultParallelism
    return entries.repartition(n, "subject_id", "file_name")


def wanted(entries: DataFrame, json_only: bool = True) -> DataFrame:
    """JSON entries, and the rows that tell of an error."""
    return entries.where(F.lower("file_name").endswith(".json") | F.col("error").isNotNull()) if json_only else entries


def archive_source(spark: SparkSession, path: str, default_subject: int = 0,
                   json_only: bool = True, by_spark: bool = False, part_bytes: int | None = None) -> DataFrame:
    """ZIP archives under ``path`` -> ``(subject_id, archive, modified_at, file_name, content, error)``.

    ``by_spark`` reads them as Spark's binary files, for stores that Python cannot open.
    """
    if by_spark:
        arch = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
        return wanted(unzip_entries(arch, default_subject), json_only)
    zip_source.register(spark)
    reader = (spark.read.format("export_zip").option("default_subject", default_subject)
              .option("json_only", str(json_only).lower()))
    if part_bytes:
        reader = reader.option("part_bytes", part_bytes)
    return reader.load(path)


def folder_source(spark: SparkSession, path: str, default_subject: int = 0) -> DataFrame:
    """S01 (unpacked): JSON files under ``path`` -> same columns as ``archive_source``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
          .option("recursiveFileLookup", "false").load(path))
    return df.select(_subject_col(df, default_subject).alias("subject_id"),
                     F.lit(None).cast("string").alias("archive"),
                     F.col("modificationTime").alias("modified_at"),
                     F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     "content", F.lit(None).cast("string").alias("error"))


def route_by_name(files: DataFrame, category: str) -> DataFrame:
    """Entries of one category (by the ordered file-name rules)."""
    return files.where(file_category("file_name") == category)


def archive_summary(files: DataFrame) -> DataFrame:
    """Entries per category plus a total row (category NULL)."""
    return (files.select(file_category("file_name").alias("category"))
            .rollup("category").agg(F.count(F.lit(1)).alias("n_files")))
