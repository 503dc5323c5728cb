"""Mixing sources to target weights.

The words ``[^\\x20\\x09-\\x0D]+`` of a source's documents, laid end to end, are
packed into blocks of ``BLOCK`` words. Output shards take ``SHARD`` slots each;
the slots of a source are drawn over the shards as multinomial counts, and the
source's slot number j takes block ``p(j mod n)`` where ``p`` is a pseudorandom
permutation of the n block indexes, another one for each round j div n. Slots
and documents meet by a join on (source, block).

Counts of a source over the shards are multinomial given the source's total (drawn
by halves of the shards, so that no task draws them all), so
totals are exact and only their spread over the shards is random. A round uses
each block once and a target is at most twice its source's size, so no block is
taken more than twice. Everything random is a hash of the seed: reruns agree.

Weights follow the sources by code point, null last: 3, 1, 2, repeating. Null
text has size 0 and takes nothing; rows that repeat a doc_id are rows of their
own (placed by doc_id, text hash, then scan position, so ``docs`` must come
from files or a checkpoint). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardiolake.llm.common import map_rows, read_table, settle

BLOCK, SHARD, PLACES, SEED = 64, 16384, 4096, 20240
#: Ranges of shards a source's slots are dealt over first (up to twice as many).
RANGES = 1024
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0  # rounds: a target stops at so many times its source's size
FIXED_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SPACES = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words: runs of other characters than white space."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(squeezed, SPACES, "")).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Target of each source in order; what a full source cannot take goes to the others by weight."""
    total = share * sum(n for _, n in sizes)
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        all_w = sum(w[i] for i in open_)
        full = [i for i in open_ if total * w[i] / all_w >= most * sizes[i][1]]
        if not full:
            for i in open_:
                out[i] = total * w[i] / all_w
            break
        for i in full:
            out[i] = most * sizes[i][1]
            open_.discard(i)
        total -= sum(out[i] for i in full)
    return out


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit hash of numbers under a key."""
    a, b, c = (np.uint64(m) for m in FIXED_MULTIPLIERS)
    x = x.astype(np.uint64) * a + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * b
    x = (x ^ (x >> np.uint64(27))) * c
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Image of ``index`` under a pseudorandom permutation of 0..n-1: a four-round Feistel
    network on the next even number of bits, walked until the value is below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = index.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        v = x[todo]
        left, right = v >> shift, v & mask
        for r in range(4):
            left, right = right, left ^ (_mixed(right, (key * 4 + r) & 0xFFFFFFFFFFFF) & mask)
        x[todo] = left << shift | right
        todo = x >= n
    return x.astype(np.int64)


def placed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """_row, doc_id, source, size, start: the document's first word within its source's words.

    A prefix sum without a window over a source: rows hash into ``PLACES``
    places per source, place totals are summed in order (at most ``PLACES``
    rows a source), and words are summed within a place.
    """
    rows = settle(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                              F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
                              F.xxhash64(text_col).alias("_tie"))
                  .withColumn("_place", F.pmod(F.xxhash64("doc_id", "_tie", "_row"), F.lit(PLACES))))
    key = ["source", "_place"]
    total = rows.groupBy(*key).agg(F.sum("size").alias("_sum"))
    before = total.withColumn("_before", F.coalesce(F.sum("_sum").over(
        Window.partitionBy("source").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.coalesce(F.sum("size").over(Window.partitionBy(*key).orderBy("doc_id", "_tie", "_row")
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = rows.withColumn("_inner", inner).alias("r")
    b = before.alias("b")
    return r.join(b, F.expr("r.source <=> b.source AND r._place = b._place")).select(
        "r._row", "r.doc_id", "r.source", "r.size", (F.col("b._before") + F.col("r._inner")).alias("start"))


def quotas(rows: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row per source: source, source_size, target, n_blocks, slots, shards, seed."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source comes to the driver: sources are kinds of data, thousands at most, not documents
    known = sorted(((r[0], r[1]) for r in sums.collect()), key=lambda x: (x[0] is None, (x[0] or "").encode("utf-8")))
    aim = targets(known)
    shards = max(1, round(sum(aim) / block / shard))
    out = []
    for k, ((source, n), t) in enumerate(zip(known, aim, strict=True)):
        blocks = -(-n // block)
        full, rest = divmod(t, n) if n else (0, 0)
        # whole rounds take every block; the last block of a source may be short, so the rest counts words
        out.append((source, n, float(t), blocks, int(full) * blocks + min(blocks, round(rest / n * blocks) if n else 0), shards, k))
    return rows.sparkSession.createDataFrame(
        out, "source string, source_size long, target double, n_blocks long, slots long, shards long, k long")


def halves(key: list[int], lo: int, hi: int, first: int, count: int, leaf: int):
    """(lo, hi, first, count): ranges of at most ``leaf`` shards with their slots, which are numbered from ``first``.

    The slots of a range fall on its halves binomially, drawn by a generator of the range's own, so all
    ranges together are multinomial and any task can go on from any range.
    """
    todo = [(lo, hi, first, count)]
    while todo:
        lo, hi, first, count = todo.pop()
        if not count:
            continue
        if hi - lo <= leaf:
            yield lo, hi, first, count
            continue
        mid = (lo + hi) // 2
        left = int(np.random.default_rng([*key, lo, hi]).binomial(count, (mid - lo) / (hi - lo)))
        todo += [(mid, hi, first + left, count - left), (lo, mid, first, left)]


def multiplicities(plan: DataFrame, seed: int = SEED) -> DataFrame:
    """(source, block, round, shard): one row per slot of the mix.

    A source's shards are drawn in two steps, ``RANGES`` ranges and then their shards, each range by a task of its own.
    """
    def draw(to_shards: bool):
        def make():
            def each(c):
                out = []
                for s, n, k, lo, hi, first, count in zip(*(c[x] for x in ("source", "n_blocks", "k", "lo", "hi", "first", "count")),
                                                         strict=True):
                    leaf = 1 if to_shards else max(1, -(-(hi - lo) // RANGES))
                    out += [(s, n, k, *r) for r in halves([seed, k], lo, hi, first, count, leaf)]
                return out
            return each
        return make

    ddl = "source string, n_blocks long, k long, lo long, hi long, first long, count long"
    # a row here stands for many slots, so the number of tasks is not left to the bytes measured
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = plan.where("slots > 0").select("source", "n_blocks", "k", F.lit(0).cast("long").alias("lo"),
                                           F.col("shards").alias("hi"), F.lit(0).cast("long").alias("first"),
                                           F.col("slots").alias("count"))
    ranges = map_rows(whole, draw(False), ddl, rows_per_output=1).repartition(tasks, "k", "lo")
    drawn = map_rows(ranges, draw(True), ddl, rows_per_output=1)

    def take():
        def each(c):
            out = []
            for s, n, k, h, first, count in zip(*(c[x] for x in ("source", "n_blocks", "k", "lo", "first", "count")), strict=True):
                j = np.arange(first, first + count)
                for r in np.unique(j // n).tolist():
                    at = permuted(j[j // n == r] % n, n, seed * 1_000_003 + k * 31 + r)
                    out += [(s, b, r, h) for b in at.tolist()]
            return out
        return each

    spread = drawn.repartition(tasks, F.xxhash64("k", "lo"))
    return map_rows(spread, take, "source string, block long, round long, shard long", rows_per_output=1)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: _row, doc_id, source, size, start; quotas; parts: _row, round, shard, lo, hi).

    A part says that words lo..hi (exclusive) of the document stand in an output shard.
    """
    rows = settle(placed(docs, id_col, text_col, source_col))
    plan = settle(quotas(rows, block))
    slots = multiplicities(plan, seed)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = (rows.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
              .select("_row", "source", "block",
                      F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("lo"),
                      F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")).alias("hi")))
    # slots grow with the corpus but look small before they are drawn: never broadcast
    a, b = pieces.alias("a"), slots.hint("merge").alias("b")
    parts = a.join(b, F.expr("a.block = b.block AND a.source <=> b.source")).select(
        "a._row", "b.round", "b.shard", "a.lo", "a.hi")
    return rows, plan, parts


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """Per input row: doc_id, size, source, source_size, target, taken."""
    rows, plan, parts = mixed(docs, **options)
    taken = parts.groupBy("_row").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    p = plan.select(F.col("source").alias("_s"), "source_size", "target")
    return (rows.join(taken, "_row", "left").join(p, F.expr("source <=> _s"), "left")
            .select("doc_id", "size", "source", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``.

    A document gives one row for each round that takes words of it. A round
    that takes all of them keeps the text as it is; otherwise the text is the
    words taken, in order, joined by one space (and ``n_chars``, if there is
    such a column, its length).
    """
    rows, _, parts = mixed(docs, id_col, text_col, source_col, **options)
    spans = (parts.groupBy("_row", "round").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("_spans"), F.sum(F.col("hi") - F.col("lo")).alias("_got"))
        .join(rows.select("_row", F.col("size").alias("_size")), "_row"))
    # the row travels as one value, so its columns cannot clash
    out = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_doc")).join(spans, "_row")
    text = F.col("_doc")[text_col]
    tokens = F.filter(F.split(text, SPACES), lambda w: w != "")
    cut = F.array_join(F.flatten(F.transform("_spans", lambda s: F.slice(
        tokens, s["lo"].cast("int") + 1, (s["hi"] - s["lo"]).cast("int")))), " ")
    whole = F.col("_got") == F.col("_size")
    out = out.select("_doc", whole.alias("_whole"), F.when(whole, text).otherwise(cut).alias("_text"))
    put = {text_col: F.col("_text")}
    if chars_col in docs.columns:
        put[chars_col] = F.when(F.col("_whole"), F.col("_doc")[chars_col]).otherwise(
            F.length("_text").cast(docs.schema[chars_col].dataType))
    return out.select(*[put.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(read_table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


QUERIES = {"op8_mixing": op8_mixing}
ORACLE: dict[str, str] = {}
