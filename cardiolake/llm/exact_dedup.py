"""Exact duplicates by content-defined chunk recipes.

A text is normalised (every character of ``[\\x20\\x09-\\x0D]`` deleted) and cut
where the content says so; its recipe is the ordered list of chunk identifiers,
packed into one binary value. Identifiers are *verified*: a pass over the
distinct chunks compares the bytes behind equal identifiers, and if two
different chunks share one, all identifiers are made anew with twice the bytes.
Documents are then compared by recipe alone, so long texts are not shuffled to
find copies; only distinct chunks move, once.

Nulls count as empty text; empty texts are equal to each other. Rows that
repeat a doc_id are rows of their own: exactly one row of a group stays (most
code points in the original, then smallest doc_id with null last, then first
in the input). An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import SPACE, attach, map_rows, read_table, settle

#: Chunk lengths in bytes: least, average step of the boundary test (a power of two), most.
LEAST, STEP, MOST = 512, 2048, 16384
WINDOW = 8
MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed odd multiplier of the boundary hash


def chunks(data: bytes) -> list[bytes]:
    """Cut where the hash of the last 8 bytes is 0 in its top bits, within the length bounds."""
    n = len(data)
    if n <= LEAST:
        return [data] if data else []
    windows = np.ndarray((n - WINDOW + 1,), dtype="<u8", buffer=data, strides=(1,))
    marks = np.flatnonzero((windows * MIX) >> np.uint64(64 - STEP.bit_length() + 1) == 0) + WINDOW
    out, start = [], 0
    for end in [*marks.tolist(), n]:
        while end - start > MOST:
            out.append(data[start:start + MOST])
            start += MOST
        if end - start >= LEAST or end == n:
            if end > start:
                out.append(data[start:end])
            start = end
    return out


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACE)


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            digest_bytes: int = 16) -> DataFrame:
    """One narrow row per input row: _row, doc_id, n_cp, text_sha256, recipe."""
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                      F.col(text_col).alias("text"))

    def make():
        def each(c):
            out = []
            for row, i, t in zip(c["_row"], c["doc_id"], c["text"], strict=True):
                data = normalised(t)
                recipe = b"".join(blake2b(x, digest_size=digest_bytes).digest() for x in chunks(data))
                out.append((row, i, len(t or ""), sha256(data).hexdigest(), recipe))
            return out
        return each

    return map_rows(src, make, "_row long, doc_id long, n_cp long, text_sha256 string, recipe binary")


def identifiers_hold(docs: DataFrame, text_col: str = "text", digest_bytes: int = 16) -> bool:
    """True if no two different chunks of the corpus share an identifier.

    Each task passes on a chunk once (its set of identifiers is emptied when
    large, which only repeats work); the bytes behind an identifier then meet
    in one map-side combined aggregate, smallest against largest.
    """
    def make():
        seen: set[bytes] = set()

        def each(c):
            out = []
            for t in c["text"]:
                for x in chunks(normalised(t)):
                    key = blake2b(x, digest_size=digest_bytes).digest()
                    mark = blake2b(x, digest_size=16, person=b"seen").digest()
                    if mark not in seen:
                        if len(seen) >= 300_000:
                            seen.clear()
                        seen.add(mark)
                        out.append((key, x))
            return out
        return each

    found = map_rows(docs.select(F.col(text_col).alias("text")), make, "id binary, chunk binary")
    clash = (found.groupBy("id").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
             .where("lo != hi"))
    return clash.limit(1).count() == 0


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_bytes: int = 16) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256 (and _row, its input position)."""
    while not identifiers_hold(docs, text_col, digest_bytes):
        digest_bytes *= 2
        if digest_bytes > 64:
            raise ValueError("chunks clash under every identifier length")
    rows = settle(recipes(docs, id_col, text_col, digest_bytes))
    best = F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "_row")
    groups = rows.groupBy("recipe").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    return attach(rows, groups, "recipe").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("best._row")).alias("kept"), "text_sha256", "_row")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns.

    Rows are told apart by their position in the scan, so ``docs`` must be read
    from files (or a checkpoint), whose partitions do not change between reads.
    """
    keep = exact_dedup(docs, id_col, text_col).where("kept").select("_row")
    return keep_rows(docs, keep)


def keep_rows(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` at the scan positions ``keep._row``."""
    # the row travels as one value, so its columns cannot clash
    return (docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_doc"))
            .join(keep, "_row", "left_semi").select("_doc.*"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir)).drop("_row")


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE = {"op5_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT h, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""}
