"""Helpers shared by the corpus operators.

Rules every operator follows: input columns are picked by name and carried
under names of its own (extra columns never clash); a null text is an empty
text unless the operator's docstring says otherwise; intermediate results that
are read twice go through ``checkpoint()`` into ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardiolake.session import ensure_checkpoint_dir

#: ASCII white space of the contracts: ``[\x20\x09-\x0D]``.
SPACE = b" \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later reads do not recompute."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    _release(df.sparkSession)
    return out


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Spark does so when the driver's memory is collected, which a driver with
    little to do puts off; operators of many short jobs would fill the disks.
    """
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Like ``settle`` for many narrow rows: a compressed table in the shared folder, read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table behind a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("table-"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Tables:
    """``stored`` that remembers its tables, so that they can be deleted when the result stands."""

    def __init__(self):
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.frames.append(stored(df))
        return self.frames[-1]

    def drop(self) -> None:
        while self.frames:
            discard(self.frames.pop())


def fold(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus`` (a null counts as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (bytes methods touch ASCII only)."""
    return text.encode().lower().split() if text else []


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], list]], schema: str,
             rows_per_output: int = 2000) -> DataFrame:
    """``mapInArrow`` one column list at a time.

    ``make()`` runs once per task and returns ``each(columns) -> rows``, where
    ``columns`` maps names to equally long Python lists (a slice of an Arrow
    batch) and ``rows`` are tuples of ``schema``. Slices are small, so memory
    follows a few thousand rows and not the partition.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_output):
                part = batch.slice(at, rows_per_output)
                out = each({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if out:
                    yield _batch(out, arrow)
        last = getattr(each, "close", None)
        if last and (out := last()):
            yield _batch(out, arrow)
        batch = part = out = None
        pa.default_memory_pool().release_unused()  # the worker process stays for further tasks

    return df.mapInArrow(run, schema)


def add_column(df: DataFrame, make: Callable[[], Callable[[list], list]], from_col: str, name: str,
               kind: str) -> DataFrame:
    """``df`` with one more column computed from ``from_col``; the others pass through as Arrow columns."""
    from pyspark.sql.types import StructType

    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"{name} {kind}").fields])
    arrow = _arrow_schema(df.sparkSession, f"{name} {kind}").field(0)
    at = df.columns.index(from_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                new = pa.array(each(part.column(at).to_pylist()), type=arrow.type)
                yield pa.RecordBatch.from_arrays([*part.columns, new], names=[*part.schema.names, name])

    return df.mapInArrow(run, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def attach(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``groups`` (one row per ``key``) to ``rows``, safe for a hot key.

    The second join column makes Spark exchange both sides for this join alone
    (an aggregate's own partitioning would be kept otherwise), and such joins
    are the ones whose oversized partitions adaptive execution splits.
    """
    r = rows.withColumn("_mix", F.xxhash64(key))
    g = groups.withColumn("_mix", F.xxhash64(key))
    return r.join(g, [key, "_mix"], how).drop("_mix")


#: Edges that a task of ``components`` contracts; sets how many tasks there are.
EDGES = 250_000


def _contracted(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v: stars that connect what the edges of a partition connect, at most 2 * ``EDGES`` at a time."""
    kind = edges.schema["u"].dataType.simpleString().replace("bigint", "long")
    arrow = _arrow_schema(edges.sparkSession, f"u {kind}, v {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def stars():
            rows = [(x, top(x)) for x in above]
            rows = [r for r in rows if r[0] != r[1]]
            for lo in range(0, len(rows), 10_000):
                yield _batch(rows[lo:lo + 10_000], arrow)
            above.clear()

        def top(x):
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        held = 0
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = top(x), top(y)
                if x < y:
                    above[y] = x
                elif y < x:
                    above[x] = y
            held += batch.num_rows
            if held >= 2 * EDGES:
                yield from stars()
                held = 0
        yield from stars()

    return edges.select("u", "v").mapInArrow(run, f"u {kind}, v {kind}")


def _are_stars(edges: DataFrame) -> bool:
    """True if every node stands below one root or is a root."""
    ends = edges.select(F.col("u").alias("x"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("v").alias("root")))
    mixed = ends.groupBy("x").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    return mixed.limit(1).count() == 0


def components(edges: DataFrame, a: str = "a", b: str = "b", tables: Tables | None = None) -> DataFrame:
    """Connected components of an undirected edge list: (node, root).

    Each task first contracts its edges to stars. While stars of different tasks
    overlap, large-star / small-star rounds follow (a number logarithmic in the
    longest chain); each is two aggregates with map-side minima and skew-splittable
    joins, and ends in a table, after which the one before is deleted. The
    number of tasks follows from the number of edges. ``root`` is the smallest
    node; nodes without edges are not returned. Null nodes must not occur. The result
    reads a table that ``tables``, if given, remembers.
    """
    first = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    tasks = max(1, -(-first.count() // EDGES))
    cur = stored(_contracted(first.coalesce(tasks)))
    discard(first)
    while not _are_stars(cur):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")).coalesce(tasks)
        large = (attach(both, low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks))
        low = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = (attach(large, low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        last, cur = cur, stored(_contracted(small.coalesce(tasks)))
        discard(last)
    if tables is not None:
        tables.frames.append(cur)
    # an edge that several tasks hold is there several times
    below = cur.distinct().select(F.col("u").alias("node"), F.col("v").alias("root"))
    return below.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
