"""Near-duplicate vectors by E8 lattice hashing, verified by cosine.

Equal vectors form a class. In each of ``tables`` tables a class's unit vector is
projected onto ``8 * blocks`` random directions and decoded to the nearest points
of the E8 lattice (scaled by ``width``); the points are its *own* cell. It also
*probes* the ``probes`` cells whose lattice points come next (the own point moved
by one of E8's 240 shortest vectors). Two classes meet in a cell that is the own
cell of one of them.

* First pass, on narrow rows (cell, class, 256 signs of random projections): which
  entries have a partner in the cell whose signs differ in few enough bits
  (5.5 standard deviations over what the threshold leaves: 2e-8 is lost). The
  vectors of all others never move.
* Second pass: the entries that are left carry their vectors, and the cosine of
  every pair that meets is computed in double precision. A pair that meets in
  several cells counts in one alone, which both classes' cells determine: the
  first table in which their own cells are equal, or else the first contact.

Cells are dealt in blocks of about ``BLOCK`` entries; every block of own entries
meets every block of the cell, in many tasks. A block passes on a number of links per
class and a spanning forest, never pairs. The first pass drops an entry if
16-bit marks say that all its pairs meet elsewhere (2**-16 of those are wrong).

Recall by simulation (64 dimensions, default settings): 0.98 at cosine 0.9, 0.995 at
0.92, above 0.9999 from 0.96. Nothing below the threshold is linked. The
number of cells is fixed by ``blocks`` and ``width`` (some 600 of equal weight for one
block of width 1.75; about the square with two, whose recall needs more tables), so
the first pass grows with the square of the rows over it.

Vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths never link. Rows may repeat a vec_id (each is
a row of its own); a null vec_id is a component's name only if it has no other. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import chain, combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import Tables, attach, components, read_table, stored

TABLES, PROBES, BLOCKS, WIDTH, SEED = 4, 4, 1, 1.75, 11
#: Signs per class (a multiple of 64), and standard deviations of the number that differ that a pair is granted.
SIGNS, GRANTED = 256, 5.5
#: Entries of one block of a cell, and own entries compared at once.
BLOCK, CHUNK = 4096, 256


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


MOVES = _shortest()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum (D8): the coordinate farthest off is rounded the other way if need be."""
    r = np.rint(x)
    off = x - r
    k = np.abs(off).argmax(-1)[..., None]
    step = np.where(np.take_along_axis(off, k, -1) >= 0, 1.0, -1.0)
    odd = (r.sum(-1) % 2 != 0)[..., None]
    np.put_along_axis(r, k, np.take_along_axis(r, k, -1) + np.where(odd, step, 0.0), -1)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 = D8 and D8 moved by a half in every coordinate."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(-1) < ((x - whole) ** 2).sum(-1)
    return np.where(closer[..., None], half, whole)


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y, summed in a fixed order: a row's result does not depend on the rows beside it."""
    out = x[..., :1] * y[0]
    for k in range(1, len(y)):
        out += x[..., k:k + 1] * y[k]
    return out


class Lattice:
    """Cells and signs of unit vectors of one length."""

    def __init__(self, size: int, tables: int, probes: int, blocks: int, width: float, seed: int):
        rng = np.random.default_rng([seed, size])
        self.tables, self.probes, self.blocks = tables, probes, blocks
        self.lines = rng.standard_normal((size, tables * blocks * 8)) / width
        self.sign_lines = rng.standard_normal((size, SIGNS))
        # odd multipliers of the points' coordinates (twice them are whole numbers), and a start for each table
        self.mix = rng.integers(0, 2**63, (blocks * 8,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.start = rng.integers(0, 2**63, (tables,), dtype=np.uint64)

    def _cells(self, points: np.ndarray) -> np.ndarray:
        """(..., tables, blocks, 8) points -> 64-bit cell names, different in every table."""
        whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
        h = (whole.reshape(*whole.shape[:-2], -1) * self.mix).sum(-1, dtype=np.uint64)
        h = h + self.start.reshape([-1] + [1] * (h.ndim - 2)) if h.ndim > 2 else h + self.start
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own cells [n, tables], probed cells [n, tables, probes])."""
        n = len(unit)
        at = _product(unit, self.lines).reshape(n, self.tables, self.blocks, 8)
        point = nearest(at)
        rest = at - point
        gain = _product(rest, MOVES.T).reshape(n, self.tables, -1)  # moves of all blocks, best first
        best = np.argsort(-gain, axis=-1, kind="stable")[..., :self.probes]
        own = self._cells(point)
        moved = np.repeat(point[:, :, None], best.shape[-1], axis=2)
        block, move = best // len(MOVES), best % len(MOVES)
        i, j, k = np.indices(best.shape)
        moved[i, j, k, block] += MOVES[move]
        return own, self._cells(moved)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """64-bit words of signs [n, SIGNS / 64]."""
        bits = np.packbits(_product(unit, self.sign_lines) >= 0, axis=1)
        return np.ascontiguousarray(bits).view(np.int64)


class Lattices(dict):
    """The lattice of each vector length that a task meets."""

    def __init__(self, options: tuple):
        super().__init__()
        self.options = options

    def __missing__(self, size: int) -> Lattice:
        self[size] = Lattice(size, *self.options)
        return self[size]


def sign_limit(threshold: float) -> int:
    """Signs in which a pair at the threshold differs at most: the mean and ``GRANTED`` standard deviations."""
    p = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    return math.ceil(SIGNS * p + GRANTED * math.sqrt(SIGNS * p * (1 - p)))


SIGN_WORDS = [f"s{i}" for i in range(SIGNS // 64)]


def marks(own: np.ndarray) -> np.ndarray:
    """16 bits of the own cell of each table (up to four in a word): [n, words]."""
    n, tables = own.shape
    wide = np.zeros((n, -(-tables // 4) * 4), np.uint16)
    wide[:, :tables] = (own.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
    return wide.view(np.int64)


def units(payloads: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision of raw components of one length."""
    x = np.frombuffer(b"".join(payloads), dtype=kind).astype(np.float64).reshape(len(payloads), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def vector_rows(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """((vec_id, cls, payload) per row, cls and payload null where nothing can link; numpy kind of a component)."""
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind, ddl = ("<f4", "array<float>") if element == "float" else ("<f8", "array<double>")
    # a component that is null makes the vector null; -0.0 counts as 0.0
    v = F.col(vector_col).cast(ddl)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fine, v).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)
            there = lists.is_valid().to_numpy(zero_copy_only=False)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            payload = [values[e - n:e].tobytes() if ok else None for ok, e, n in zip(there, ends, lengths, strict=True)]
            cls = [None if p is None else blake2b(p, digest_size=16).digest() for p in payload]
            yield pa.RecordBatch.from_arrays([ids, pa.array(cls, pa.binary()), pa.array(payload, pa.binary())],
                                             names=["vec_id", "cls", "payload"])

    return src.mapInArrow(run, "vec_id long, cls binary, payload binary"), kind


def _by_length(payloads: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    sizes = np.array([len(p) for p in payloads])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, [payloads[i] for i in at]


def entries(classes: DataFrame, kind: str, options: tuple) -> DataFrame:
    """One narrow row per class and cell: cell, cid, tab, own, s0... (signs), m0... (marks of own cells)."""
    tables = options[0]
    words = -(-tables // 4)
    names = ["cell", "cid", "tab", "own", *SIGN_WORDS, *[f"m{i}" for i in range(words)]]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_()] + [pa.int64()] * (len(names) - 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = Lattices(options)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                cids = part.column(0).to_numpy(zero_copy_only=False)
                for at, some in _by_length(part.column(1).to_pylist()):
                    unit = units(some, kind)
                    grid = grids[unit.shape[1]]
                    own, probed = grid.cells(unit)
                    n, each = len(at), 1 + probed.shape[2]
                    cell = np.concatenate([own[:, :, None], probed], axis=2).reshape(-1)
                    mine = np.zeros((n, tables, each), bool)
                    mine[:, :, 0] = True
                    per = tables * each
                    wide = np.concatenate([grid.signs(unit), marks(own)], axis=1)
                    columns = [cell, np.repeat(cids[at], per),
                               np.tile(np.repeat(np.arange(tables, dtype=np.int32), each), n), mine.reshape(-1),
                               *[np.repeat(wide[:, i], per) for i in range(wide.shape[1])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    ddl = "cell long, cid long, tab int, own boolean" + "".join(f", {n} long" for n in names[4:])
    return classes.select("cid", "payload").mapInArrow(run, ddl)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (cell, cid, own, ...) dealt into blocks, grouped and sorted by (cell, i, j), with ``a`` and ``b``.

    In block (i, j) of a cell the own entries with ``a`` meet the entries with ``b``. Only cells over
    ``BLOCK`` entries have more than one block, and only they are joined: by broadcast if Spark
    finds their table small, else by sort.
    """
    big = stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("own").cast("long")).alias("_k"))
                 .where((F.col("_n") > BLOCK) & (F.col("_k") > 0)))
    parts = rows.join(big, "cell", "left")

    def blocks(count: str):
        return F.coalesce(F.ceil(F.col(count) / F.lit(BLOCK)), F.lit(1)).cast("int")

    parts = (parts.withColumn("na", blocks("_k")).withColumn("nb", blocks("_n"))
             .withColumn("ha", F.pmod(F.xxhash64("cid"), F.col("na")).cast("int"))
             .withColumn("hb", F.pmod(F.xxhash64("cid", F.lit(5)), F.col("nb")).cast("int")))
    as_b = F.transform(F.sequence(F.lit(0), F.col("na") - 1), lambda i: F.struct(i.alias("i"), F.col("hb").alias("j")))
    as_a = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.col("ha").alias("i"), j.alias("j")))
    spots = F.when(F.col("own"), F.array_union(as_a, as_b)).otherwise(as_b)
    out = (parts.withColumn("e", F.explode(spots)).withColumn("i", F.col("e.i")).withColumn("j", F.col("e.j"))
           .withColumn("a", F.col("own") & (F.col("i") == F.col("ha"))).withColumn("b", F.col("j") == F.col("hb"))
           .drop("_n", "_k", "na", "nb", "ha", "hb", "e"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(n, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")


def each_block(rows: DataFrame, make: Callable[[], Callable[[pa.Table], pa.Table | None]], schema: str) -> DataFrame:
    """Calls ``make()(block)`` for every (cell, i, j) of two entries or more; blocks follow one another in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, held, out, size = make(), None, [], 0
        stop = object()
        for batch in chain(batches, [stop]):
            last = batch is stop
            if last:
                table, whole = held, True
            else:
                new = pa.Table.from_batches([batch])
                table, whole = (new if held is None else pa.concat_tables([held, new])), False
            if table is None or not table.num_rows:
                continue
            key = np.stack([table.column(c).to_numpy() for c in ("cell", "i", "j")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), table.num_rows]
            upto = len(bounds) - 1 if whole else len(bounds) - 2
            for x, y in zip(bounds[:upto], bounds[1:upto + 1]):
                if y - x > 1:
                    got = one(table.slice(x, y - x))
                    if got is not None:
                        out.append(got)
                        size += got.num_rows
                        if size > 20_000:
                            yield from pa.concat_tables(out).combine_chunks().to_batches()
                            out, size = [], 0
            held = table.slice(bounds[upto]) if not whole else None
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def _matrix(table: pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in names], axis=1)


def live_entries(rows: DataFrame, tables: int, limit: int) -> DataFrame:
    """(cell, cid, tab, own) of the entries with a partner near enough by signs whose meeting place may be here."""
    words = [f"m{i}" for i in range(-(-tables // 4))]
    arrow = pa.schema([("cell", pa.int64()), ("cid", pa.int64()), ("tab", pa.int32()), ("own", pa.bool_())])

    def make():
        def one(t: pa.Table):
            own, b = t.column("own").to_numpy(zero_copy_only=False), t.column("b").to_numpy(zero_copy_only=False)
            a_at, b_at = np.flatnonzero(t.column("a").to_numpy(zero_copy_only=False)), np.flatnonzero(b)
            if not len(a_at) or not len(b_at):
                return None
            tab = t.column("tab").to_numpy()
            signs = _matrix(t, SIGN_WORDS).view(np.uint64)
            mark = np.ascontiguousarray(_matrix(t, words)).view(np.uint16)
            cid, keep = t.column("cid").to_numpy(), np.zeros(t.num_rows, bool)
            for lo in range(0, len(a_at), CHUNK):
                some = a_at[lo:lo + CHUNK]
                off = np.zeros((len(some), len(b_at)), np.uint16)
                for k in range(len(SIGN_WORDS)):
                    off += np.bitwise_count(signs[some, None, k] ^ signs[None, b_at, k])
                x, y = np.nonzero(off <= limit)
                x, y = some[x], b_at[y]
                other = cid[x] != cid[y]
                x, y = x[other], y[other]
                if len(x):
                    same = mark[x][:, :tables] == mark[y][:, :tables]
                    # met by own cells: in the first such table; by a probe: only if never by own cells
                    here = np.where(own[y], same.argmax(1) == tab[x], ~same.any(1))
                    keep[x[here]] = True
                    keep[y[here]] = True
            if not keep.any():
                return None
            return t.select(["cell", "cid", "tab", "own"]).filter(pa.array(keep)).cast(arrow)
        return one

    return (each_block(dealt(rows), make, "cell long, cid long, tab int, own boolean")
            .distinct())  # an entry may stand in several blocks of its cell


def links(rows: DataFrame, kind: str, options: tuple, threshold: float) -> DataFrame:
    """(cid, links, root): per block, the links of each class counted with the sizes of its partners, and a forest.

    ``rows``: cell, cid, tab, own, n (rows of the class), payload.
    """
    arrow = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    tables = options[0]

    def make():
        grids = Lattices(options)

        def one(t: pa.Table):
            a_at = np.flatnonzero(t.column("a").to_numpy(zero_copy_only=False))
            b_at = np.flatnonzero(t.column("b").to_numpy(zero_copy_only=False))
            if not len(a_at) or not len(b_at):
                return None
            payload = t.column("payload").to_pylist()
            lengths = np.array([len(p) for p in payload])
            if (lengths != lengths[0]).any():  # cells of vectors of different lengths that share a name by chance
                parts = [one(t.filter(pa.array(lengths == n))) for n in np.unique(lengths)]
                parts = [p for p in parts if p is not None]
                return pa.concat_tables(parts) if parts else None
            unit = units(payload, kind)
            mine, probed = grids[unit.shape[1]].cells(unit)
            own = t.column("own").to_numpy(zero_copy_only=False)
            cid, size, tab, cell = (t.column(c).to_numpy() for c in ("cid", "n", "tab", "cell"))
            count = np.zeros(t.num_rows, np.int64)
            ends = []
            for lo in range(0, len(a_at), CHUNK):
                some = a_at[lo:lo + CHUNK]
                x, y = np.nonzero(unit[some] @ unit[b_at].T >= threshold)
                x, y = some[x], b_at[y]
                other = cid[x] != cid[y]
                x, y = x[other], y[other]
                here = _meets_here(mine, probed, x, y, own[y], int(tab[0]), int(cell[0]), tables)
                x, y = x[here], y[here]
                np.add.at(count, x, size[y])
                far = ~own[y]  # own entries are counted when they stand on the other side
                np.add.at(count, y[far], size[x[far]])
                ends.append(_forest(x, y))
            x, y = _forest(*np.concatenate(ends, axis=1))
            if not len(x):
                return None
            nodes = np.flatnonzero(count)
            top = np.arange(t.num_rows)
            top[y] = x  # a forest of stars
            nodes = np.union1d(nodes, np.union1d(x, y))
            return pa.table([cid[nodes], count[nodes], cid[top[nodes]]], schema=arrow)
        return one

    return each_block(dealt(rows), make, "cid long, links long, root long")


def _meets_here(mine, probed, x, y, y_owns, tab: int, cell: int, tables: int) -> np.ndarray:
    """Which pairs (x owns this cell) count in this cell of table ``tab``."""
    same = mine[x] == mine[y]
    ever, first = same.any(1), same.argmax(1)
    # contacts by probes: y probes x's own cell, or x probes y's
    hit = (probed[y] == mine[x][:, :, None]).any(2)
    back = (probed[x] == mine[y][:, :, None]).any(2)
    touch = hit | back
    early = touch.argmax(1) == tab
    # if both probe each other's cells, the smaller name counts
    place = np.where(back[:, tab], np.minimum(mine[x][:, tab], mine[y][:, tab]), mine[x][:, tab]) == cell
    return np.where(y_owns, ever & (first == tab), ~ever & early & hit[:, tab] & place)


def _forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Stars (root, node) that connect what the pairs connect; roots are the smallest places."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    if not len(nodes):
        return np.zeros((2, 0), np.int64)
    a, b = at[:len(x)], at[len(x):]
    top = np.arange(len(nodes))
    while True:
        low = np.minimum(top[a], top[b])
        new = top.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, top[a], low)
        np.minimum.at(new, top[b], low)
        new = new[new]
        if (new == top).all():
            break
        top = new
    far = np.flatnonzero(top != np.arange(len(nodes)))
    return np.stack([nodes[top[far]], nodes[far]])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                 tables: int = TABLES, probes: int = PROBES, blocks: int = BLOCKS, width: float = WIDTH,
                 seed: int = SEED) -> DataFrame:
    """Per input row: vec_id, n_links (other rows linked directly), component_id, kept."""
    options = (tables, probes, blocks, width, seed)
    rows, kind = vector_rows(vectors, id_col, vector_col)
    found = rows.where("cls is not null").groupBy("cls").agg(
        F.min(F.struct(F.col("vec_id").isNull().alias("z"), "vec_id")).alias("m"), F.count(F.lit(1)).alias("n"),
        F.first("payload").alias("payload"))
    # written as a table first: the number of a class must not change
    scratch = Tables()
    classes = scratch(found.select("cls", F.col("m.vec_id").alias("low"), "n", "payload")
                     .withColumn("cid", F.monotonically_increasing_id()))
    live = scratch(live_entries(entries(classes, kind, options), options[0], sign_limit(threshold)))
    near = scratch(links(attach(live, classes.select("cid", "n", "payload"), "cid"), kind, options, threshold))
    counts = near.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(near.select(F.col("cid").alias("a"), F.col("root").alias("b")), tables=scratch)
    placed = (classes.select("cls", "cid", "low", "n").join(counts, "cid", "left")
              .join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
              .withColumn("root", F.coalesce("root", "cid")))
    least = placed.groupBy("root").agg(F.min(F.struct(F.col("low").isNull().alias("z"), "low")).alias("m"))
    named = stored(attach(placed, least, "root").select(
        "cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("m.low").alias("component_id")))
    scratch.drop()  # the result reads the input and ``named`` alone
    # classes are joined null-safe: a row without one links with nothing
    out = attach(rows.select("vec_id", "cls"), named, "cls", "left")
    none = F.col("cls").isNull()
    return (out.select("vec_id", F.when(none, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                       F.when(none, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op11_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_lattice_dedup": op11_lattice_dedup}
ORACLE = {"op11_lattice_dedup": r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
f AS (
  SELECT r, vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.r AS r, a.vec_id AS a, b.r AS s, b.vec_id AS b FROM f a JOIN f b
    ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT r, r AS s FROM f UNION SELECT reach.r, p.s FROM reach JOIN p ON p.r = reach.s),
c AS (SELECT reach.r, min(f.vec_id) AS component_id FROM reach JOIN f ON f.r = reach.s GROUP BY reach.r),
n AS (SELECT r, count(*) AS n_links FROM p GROUP BY r)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       v.vec_id = coalesce(component_id, v.vec_id) AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN c USING (r)
"""}
