"""Sharding by fixed virtual slots (DataFrame functions only).

Records hash into ``SLOTS`` virtual slots for good. A slot-to-shard map, a table
of ``SLOTS`` rows with a version, says where a slot lives; rebalancing edits the
map and gives the edit the next version, so a record moves only if its slot
does. A version counts once it is written whole; a lost write leaves a number unused. The query keeps the maps of each input in the shared folder: it goes on from
the newest one and stores an edit as the next version (without a move, no new
version), so its shards follow from the documents and the version it began with,
which it reports. Loads are bytes per slot (an aggregate with map-side sums); the map is
edited on the driver, which sees ``SLOTS`` numbers whatever the size of the data.

Law: ``bytes``. ``rebalanced`` moves slots from shards above the mean to shards
below it until no move helps, then swaps; shards then differ by about one small
slot, unless a single record outweighs a share.

size: UTF-8 bytes of the text (null: none) plus 1. Records hash by doc_id and
text, so rows that repeat a doc_id with other texts spread; rows that repeat
both share a slot. A null doc_id hashes like any other value. ``slot`` numbers
a shard's rows 0, 1, 2, ...: counts per virtual slot give each its offset, and
a row is numbered inside its virtual slot only (by doc_id, null first, then
text hash), so no window holds more than a slot.
"""

from __future__ import annotations

import json
from hashlib import blake2b

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardiolake.llm.common import read_table, settle
from cardiolake.session import ensure_checkpoint_dir

SLOTS, SHARDS = 4096, 8


def first_map(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt round-robin."""
    return [s % shards for s in range(slots)]


def rebalanced(placing: list[int], load: dict[int, int], shards: int) -> list[int]:
    """The next version: as few slots as needed change shard (``shards`` may have grown).

    The heaviest shard gives the largest slot that fits into half its lead over
    the lightest one, again and again; when none fits, the two swap the pair of
    slots whose difference comes nearest to half the lead.
    """
    out, total = list(placing), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for s, k in enumerate(out):
        if load.get(s, 0):
            held[k].append((load[s], s))
            total[k] += load[s]
    for h in held:
        h.sort()
    for _ in range(8 * len(out)):
        top, low = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[top] - total[low]
        give = max((x for x in held[top] if 2 * x[0] <= gap), default=None)
        back = None
        if give is None:
            give, back = _swap(held[top], held[low], gap)
            if give is None:
                break
        for x, a, b in ((give, top, low), (back, low, top)):
            if x:
                held[a].remove(x)
                held[b].append(x)
                held[b].sort()
                total[a] -= x[0]
                total[b] += x[0]
                out[x[1]] = b
    return out


def _swap(top, low, gap):
    """A pair whose exchange narrows the gap most: differences strictly between 0 and the gap."""
    best, found, j = gap, (None, None), 0
    for x in top:
        while j < len(low) and 2 * (x[0] - low[j][0]) > gap:
            j += 1
        for k in (j - 1, j):
            if 0 <= k < len(low):
                d = x[0] - low[k][0]
                if 0 < d < gap and abs(gap - 2 * d) < best:
                    best, found = abs(gap - 2 * d), (x, low[k])
    return found


def map_table(spark: SparkSession, placing: list[int], version: int, offsets: list[int] | None = None) -> DataFrame:
    """(virtual_slot, shard, version) of one map version, and ``offset`` if given. The map is one literal."""
    kind = "array<struct<shard:int" + (",offset:long>>" if offsets else ">>")
    rows = json.dumps([{"shard": k, **({"offset": offsets[i]} if offsets else {})} for i, k in enumerate(placing)])
    return (spark.range(1).select(F.posexplode(F.from_json(F.lit(rows), kind)).alias("virtual_slot", "_m"))
            .select("virtual_slot", "_m.*", F.lit(version).alias("version")))


def versions(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """(numbers of the versions that were written whole, largest number there is a folder for)."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return [], 0
    whole, last = [], 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("version=") and name[8:].isdigit():
            last = max(last, int(name[8:]))
            if fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                whole.append(int(name[8:]))
    return sorted(whole), last


def save_map(spark: SparkSession, placing: list[int], version: int, path: str) -> None:
    """Store a version as ``path/version=<n>``; earlier versions stay. An existing version is an error."""
    map_table(spark, placing, version).drop("version").coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def store_map(spark: SparkSession, placing: list[int], path: str) -> int:
    """Store a map under the next free number, also past folders that a lost write left; the number."""
    while True:
        version = versions(spark, path)[1] + 1
        try:
            save_map(spark, placing, version, path)
            return version
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise  # another writer took the number: try the next one


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """(version, placing) of the given or the newest whole version."""
    if version is None:
        version = versions(spark, path)[0][-1]
    rows = spark.read.parquet(f"{path}/version={version}").orderBy("virtual_slot").select("shard").collect()
    return version, [r[0] for r in rows]


def newest_map(spark: SparkSession, path: str) -> tuple[int, list[int]] | None:
    """(version, placing) of the newest whole version, None if there is none."""
    return load_map(spark, path) if versions(spark, path)[0] else None


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Narrow records: doc_id, size, text_crc32, virtual_slot, _tie."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tie = F.xxhash64(text)
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), tie.alias("_tie"),
        F.pmod(F.xxhash64(F.col(id_col), tie), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
               id_col: str = "doc_id", text_col: str = "text", placing: list[int] | None = None,
               version: int = 0, maps: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version, from_version.

    ``placing`` continues the map of that ``version``, and ``maps`` the newest one stored in that folder, where
    an edit is stored as the next version; without one, version 0 deals slots round-robin. Rows follow from the
    documents and the map of ``from_version``: equal input from an equal map gives equal rows.
    """
    spark = docs.sparkSession
    records = settle(slotted(docs, id_col, text_col, slots))
    loads = {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in slot_loads(records).collect()}  # at most `slots` rows
    if maps and (stored := newest_map(spark, maps)):
        version, placing = stored
    before = placing or first_map(shards, slots)
    began = version
    if len(before) != slots:
        raise ValueError(f"the map has {len(before)} slots, not {slots}")
    placing = rebalanced(before, {s: b for s, (b, _) in loads.items()}, shards)
    if placing != before or version == 0:
        version = store_map(spark, placing, maps) if maps else version + 1
    offset, filled = [], [0] * shards
    for s, k in enumerate(placing):
        offset.append(filled[k])
        filled[k] += loads.get(s, (0, 0))[1]
    places = map_table(spark, placing, version, offset)
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "_tie"))
    # the map has `slots` rows by construction
    return (records.withColumn("_at", within).join(F.broadcast(places), "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("_at") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
                    F.lit(began).alias("from_version")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    maps = f"{shared}/shard-maps/{blake2b(sf_dir.encode(), digest_size=8).hexdigest()}"
    return shard_rows(read_table(spark, sf_dir), maps=maps)


QUERIES = {"op4_sharding": op4_sharding}
ORACLE: dict[str, str] = {}
