"""Importance resampling towards a target text distribution, by distinct lines.

Features are all runs of 1 to ``longest`` consecutive words (joined by one
space), hashed by crc32 into ``buckets``. A bucket's gain is the scaled logarithm
of its share in the target texts over its share in the documents; a document's
weight is the floored mean of its features' gains. Gumbel noise from the row's id
makes the highest scores a draw without replacement.

Segments: a newline separates words, so it cuts a text into lines whose runs of
words do not depend on their neighbours. Each distinct line is hashed once and
its feature counts are multiplied by its occurrences; a document's sums are those
of its lines. Runs that cross a line end (``longest`` of 2 or more) are found from
the words around each line end and added separately.

The counts of all buckets (their number is a parameter) and one total per sorted
range are all that the driver sees.

Null and wordless texts have no features and weight 0; they are not drawn unless
``least`` is 0. Rows that repeat an id have the same noise and are rows of their
own; a null id hashes like an empty one and comes last among ties. Without target
texts all gains follow from the documents alone. An empty table gives an empty
result. Rows are told apart by scan position, so ``docs`` must be files or a checkpoint.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import attach, map_rows, read_table, stored
from cardiolake.operators.ranking import with_row_rank

#: Separators of words: every ASCII character but digits and letters; A-Z become lower case.
_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))
BUCKETS, SCALE = 10_000, 1000
#: Words whose bucket a task remembers, emptied when full (which only repeats work).
CACHE = 200_000


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


class Hasher:
    """Buckets of runs of words."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.known = longest, buckets, {}

    def _one(self, feature: bytes) -> int:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        b = known.get(feature)
        if b is None:
            b = known[feature] = crc32(feature) % self.buckets
        return b

    def inside(self, line: list[bytes]) -> list[int]:
        """Buckets of all runs within a line."""
        out = [self._one(w) for w in line]
        for n in range(2, self.longest + 1):
            out.extend(self._one(b" ".join(line[i:i + n])) for i in range(len(line) - n + 1))
        return out

    def across(self, lines: list[list[bytes]]) -> list[int]:
        """Buckets of all runs that cross a line end: only ``longest - 1`` words on either side can take part."""
        reach = self.longest - 1
        if reach < 1:
            return []
        flat = list(chain.from_iterable(lines))
        ends = set(np.cumsum([len(x) for x in lines])[:-1].tolist()) - {0, len(flat)}
        out = []
        for n in range(2, self.longest + 1):
            starts = {i for e in ends for i in range(max(0, e - n + 1), min(e, len(flat) - n + 1))}
            out.extend(self._one(b" ".join(flat[i:i + n])) for i in starts)
        return out


def lines_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(_row, key, line) of every line that holds more than white space; ``key`` is the line's digest."""
    # rows are numbered before the lines are laid out (in one select the lines would be numbered)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("text"))
    src = rows.select("_row", F.explode(F.split("text", "\n")).alias("line"))
    src = src.where(F.length(F.trim("line")) > 0)
    return src.withColumn("key", F.unhex(F.substring(F.sha2("line", 256), 1, 32)))


def hashed_lines(lines: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(key, times, n_words, features) of each distinct line; ``features`` are its buckets, repeats included. Stored."""
    distinct = lines.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.first("line").alias("line"))

    def make():
        hasher = Hasher(longest, buckets)

        def each(c):
            out = []
            for key, times, line in zip(c["key"], c["times"], c["line"], strict=True):
                w = words(line)
                out.append((key, times, len(w), hasher.inside(w)))
            return out
        return each

    return stored(map_rows(distinct, make, "key binary, times long, n_words long, features array<int>", rows_per_output=500))


def crossing(docs: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """(_row, features) of the runs that cross a line end, for documents that have any. Stored."""
    src = (docs.select(F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("text"))
           .where(F.contains("text", F.lit("\n"))))

    def make():
        hasher = Hasher(longest, buckets)

        def each(c):
            rows = [(row, hasher.across([words(x) for x in t.split("\n")])) for row, t in zip(c["_row"], c["text"], strict=True)]
            return [r for r in rows if r[1]]
        return each

    return stored(map_rows(src, make, "_row long, features array<int>", rows_per_output=200))


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket in (times, features) rows: a vector per task, summed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("features"))
            times = batch.column(batch.schema.get_field_index("times")).to_numpy(zero_copy_only=False)
            np.add.at(total, lists.flatten().to_numpy(zero_copy_only=False),
                      np.repeat(times, np.diff(lists.offsets.to_numpy())))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["b", "c"])

    sums = features.select("times", "features").mapInArrow(run, "b int, c long").groupBy("b").agg(F.sum("c").alias("c"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r["b"]] = r["c"]
    return out


def corpus_counts(docs: DataFrame, text_col: str = "text", longest: int = 1,
                  buckets: int = BUCKETS) -> tuple[np.ndarray, DataFrame, DataFrame, DataFrame | None]:
    """(counts by bucket, line places (_row, key), hashed lines, crossing runs or None)."""
    lines = lines_of(docs, text_col)
    hashed = hashed_lines(lines, longest, buckets)
    counts = bucket_counts(hashed, buckets)
    cross = None
    if longest > 1:
        cross = crossing(docs, text_col, longest, buckets)
        counts = counts + bucket_counts(cross.withColumn("times", F.lit(1).cast("long")), buckets)
    return counts, lines.select("_row", "key"), hashed, cross


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln of the ratio of add-one shares), a whole number per bucket."""
    n = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((float(t) + 1.0) * (s_all + n) / ((float(s) + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _summed(features: DataFrame, gain: np.ndarray, keep: str, kind: str) -> DataFrame:
    """``keep`` columns, number of features and sum of gains of each row of ``features``."""
    names = keep.split(",")

    def make():
        def each(c):
            return [(*[c[k][i] for k in names], len(f), int(gain[np.asarray(f, np.int64)].sum()))
                    for i, f in enumerate(c["features"])]
        return each

    return map_rows(features.select(*names, "features"), make, f"{kind}, n long, g long")


def weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            target_text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, scale: int = SCALE) -> DataFrame:
    """Per input row: _row, doc_id, n_features, n_words, weight."""
    source_counts, places, hashed, cross = corpus_counts(docs, text_col, longest, buckets)
    target_counts = corpus_counts(target, target_text_col, longest, buckets)[0]
    gain = gains(source_counts, target_counts, scale)
    per_line = _summed(hashed, gain, "key,n_words", "key binary, n_words long")
    # a document that repeats a line joins it once; a line that many documents share is a hot key
    mine = places.groupBy("_row", "key").agg(F.count(F.lit(1)).alias("k"))
    sums = attach(mine, per_line, "key").select(
        "_row", (F.col("k") * F.col("n")).alias("n"), (F.col("k") * F.col("g")).alias("g"),
        (F.col("k") * F.col("n_words")).alias("w"))
    if cross is not None:
        sums = sums.unionByName(_summed(cross, gain, "_row", "_row long").withColumn("w", F.lit(0).cast("long")))
    sums = sums.groupBy("_row").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("w").alias("w"))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"))
    zero = F.lit(0).cast("long")
    whole = F.expr("(g - pmod(g, n)) div n")  # floors go down
    return rows.join(sums, "_row", "left").select(
        "_row", "doc_id", F.coalesce("n", zero).alias("n_features"), F.coalesce("w", zero).alias("n_words"),
        F.when(F.col("n") > 0, whole).otherwise(zero).alias("weight"))


def noise(id_col: str = "doc_id", seed: int = 2024, scale: int = SCALE):
    """floor(scale * Gumbel noise) of a row's id: h is 32 bits of its sha256."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def importance_sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      target_text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, scale: int = SCALE,
                      seed: int = 2024, least: int = 20, percent: int = 10) -> DataFrame:
    """Per input row: doc_id, n_features, weight, score, rank (null unless drawn) and _row.

    Of the rows with at least ``least`` words ``percent`` of a hundred (floored) are drawn.
    """
    scored = stored(weights(docs, target, id_col, text_col, target_text_col, longest, buckets, scale)
                    .withColumn("score", F.col("weight") + noise("doc_id", seed, scale)))
    able = scored.where(F.col("n_words") >= least)
    quota = able.count() * percent // 100
    order = [("score", True), ("doc_id", False), ("_row", False)]
    drawn = (with_row_rank(able.select("_row", "doc_id", "score"), order).where(F.col("rank") <= quota)
             .select("_row", "rank"))
    return scored.join(drawn, "_row", "left").select("doc_id", "n_features", "weight", "score", "rank", "_row")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(read_table(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).drop("_row")


QUERIES = {"op13_importance": op13_importance}
ORACLE = {"op13_importance": r"""
WITH t256 AS (  -- crc32 of each byte value, by its eight steps
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
vocab AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bucket AS (
  SELECT word, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(length(hx) // 2), lambda j: CAST('0x' || substr(hx, 2 * j + 1, 2) AS BIGINT))),
      lambda c, x: xor(c // 256, tab[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS BIGINT) AS bk
  FROM vocab, t256),
s AS (SELECT bk, count(*) AS s FROM dw JOIN bucket USING (word) GROUP BY bk),
t AS (SELECT bk, count(*) AS t FROM bw JOIN bucket USING (word) GROUP BY bk),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS sa, (SELECT coalesce(sum(t), 0) FROM t) AS ta),
gain AS (
  SELECT s.bk, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + 10000)::DOUBLE
                                    / ((s + 1)::DOUBLE * (ta + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bk), tot),
w AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM dw JOIN bucket USING (word) JOIN gain USING (bk) GROUP BY doc_id),
h AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
         CAST(CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM documents LEFT JOIN w USING (doc_id)),
sc AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM h),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE n_features >= 20),
q AS (SELECT 10 * count(*) // 100 AS quota FROM sc WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= quota THEN rank END AS rank
FROM sc LEFT JOIN rk USING (doc_id), q
"""}
