"""Document fingerprints: a homomorphic multiset hash over paragraphs (DataFrame functions only).

A text is split into paragraphs (at line breaks, and after ``.``, ``!`` or ``?``
before a space, so that single-line texts have several). Each paragraph hashes
to a wide vector of ``LANES`` numbers modulo ``2**BITS``, and the fingerprint is
the sum of these vectors modulo that power. Hence the order of paragraphs does
not matter, equal multisets have equal fingerprints, and paragraphs are inserted
by adding and deleted by subtracting their vectors (``combined``, ``removed``).

Every entry has a hashed +1 or -1 in its ``SIGN_BITS`` low bits and hashed bits
above them, so the low bits of a lane hold a sum of signs (below ``2**31`` in
amount, as a text has fewer paragraphs). Likeness of two fingerprints is the
cosine of these sums, which estimates the cosine of the two multisets (the
share of paragraphs in common, for texts of equal size) whatever their length,
with a standard error of at most about ``1 / sqrt(LANES)``. Below 0 it counts as
0; equal fingerprints have 1.0 (also two empty ones).

Null counts as empty text; the fingerprint of a text without paragraphs is all
zeros. Documents are ordered by descending doc_id, null last, equal ids by text
hash; the one after the last is the first, so a lone document is its own next.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardiolake.llm.common import read_table

LANES, BITS, SIGN_BITS = 64, 48, 32
MASK = (1 << BITS) - 1
PARAGRAPH = r"\n|(?<=[.!?]) "
#: Rows of a range of doc_id, and limits of one level: a literal list of so many numbers, and a table of as many such lists.
ROWS_PER_RANGE, LIMITS = 4096, 2048


def fingerprint(text: Column) -> Column:
    """Text -> array of ``LANES`` numbers below 2**BITS."""
    units = F.filter(F.split(text, PARAGRAPH), lambda p: F.length(F.trim(p)) > 0)
    hashes = F.transform(units, lambda p: F.xxhash64(F.trim(p)))
    wide = F.lit((MASK >> SIGN_BITS) << SIGN_BITS)

    def entry(h: Column, lane: Column) -> Column:
        x = F.xxhash64(h, lane)  # its high bits fill the lane's, its lowest bit is the sign
        return x.bitwiseAND(wide) + F.lit(1) - x.bitwiseAND(F.lit(1)) * 2

    lanes = F.array(*[F.lit(i) for i in range(LANES)])
    # the outer transform, over one element, keeps the hashes from being computed again for each lane
    return F.transform(F.array(hashes), lambda own: F.transform(lanes, lambda lane: F.aggregate(
        own, F.lit(0).cast("long"), lambda acc, h: (acc + entry(h, lane)).bitwiseAND(F.lit(MASK)))))[0]


def combined(a: Column, b: Column) -> Column:
    """Fingerprint of both texts' paragraphs together (insertion)."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def removed(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b`` (deletion)."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def as_hex(print_: Column) -> Column:
    return F.lower(F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x), BITS // 4, "0")), ""))


def signs(print_: Column) -> Column:
    """The sums of signs of a fingerprint's lanes."""
    half = 1 << (SIGN_BITS - 1)
    return F.transform(print_, lambda x: ((x + F.lit(half)).bitwiseAND(F.lit((1 << SIGN_BITS) - 1)) - F.lit(half)).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sums of signs, at least 0; 1.0 for equal fingerprints."""
    def product(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    x, y = signs(a), signs(b)
    norm = F.sqrt(product(x, x)) * F.sqrt(product(y, y))
    return (F.when(a == b, F.lit(1.0)).when(norm == 0, F.lit(0.0))
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), product(x, y) / norm))))


def _limits(rows: DataFrame, key: str, parts: int, by: list[str]) -> DataFrame:
    """(by, limits descending): the largest key and about ``parts`` - 1 quantiles, all of them keys that occur."""
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else None
    found = F.array(F.max(key)) if steps is None else F.array_append(F.percentile_approx(key, steps, 10 * parts), F.max(key))
    return rows.groupBy(*by).agg(F.sort_array(F.array_distinct(found), asc=False).alias("limits"))


def _number(key: str, limits: Column) -> Column:
    """Which range of the descending ``limits`` a key is in: the first begins with the first limit."""
    return F.size(F.filter(limits, lambda x: x >= F.col(key))) - 1


def with_next(docs: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Each row with ``next``, a struct of the next row's ``columns`` by descending ``key`` (cyclic).

    No window spans the table. Rows are dealt into ranges of ``key`` of about ``ROWS_PER_RANGE`` rows by two
    levels of limits; limits are keys that occur, so a range begins with the rows of its limit, which are also
    put, marked, at the end of the range before. Texts move once. Rows without a key are the last range; they
    and the rows of one key stay together.
    """
    keyed = docs.where(F.col(key).isNotNull())
    n = keyed.count()
    low = docs.where(F.col(key).isNull()).agg(F.min("_tie")).first()[0]  # None: every row has a key
    parts = max(1, -(-n // ROWS_PER_RANGE))
    coarse = min(LIMITS, parts)
    top = (_limits(keyed, key, coarse, []).first()["limits"] if n else []) or []
    placed = docs
    if parts > coarse:
        # at most LIMITS rows of lists of as many numbers: a bound that does not depend on the data
        fine = (_limits(keyed.withColumn("_c", _number(key, F.array(*map(F.lit, top)))), key, min(LIMITS, -(-parts // coarse)), ["_c"])
                .select("_c", F.col("limits").alias("_fine")))
        sizes = {r["_c"]: r["s"] for r in fine.select("_c", F.size("_fine").alias("s")).collect()}
        starts = [sum(sizes.get(j, 0) for j in range(i)) for i in range(len(top))]
        ranges = sum(sizes.values())
        placed = (docs.withColumn("_c", F.when(F.col(key).isNotNull(), _number(key, F.array(*map(F.lit, top)))))
                  .join(F.broadcast(fine), "_c", "left"))
        own = F.get(F.array(*map(F.lit, starts)), F.col("_c")) + _number(key, F.col("_fine"))
        begins = F.array_contains("_fine", F.col(key))
    else:
        ranges = len(top)
        own = _number(key, F.array(*map(F.lit, top))) if top else F.lit(0)
        begins = F.col(key).isin(*top) if top else F.lit(False)
    null_range = ranges  # behind all others
    last = ranges if low is not None else ranges - 1
    keyless = F.col(key).isNull()
    own = F.when(keyless, F.lit(null_range)).otherwise(own)
    first = F.when(keyless, F.col("_tie") == F.lit(low)).otherwise(begins)
    placed = placed.withColumn("_own", own).withColumn("_first", first)
    before = F.when(F.col("_own") == 0, F.lit(last)).otherwise(F.col("_own") - 1)
    if ranges == 0:
        before = F.lit(null_range)
    spots = F.array_compact(F.array(F.struct(F.col("_own").alias("r"), F.lit(False).alias("head")),
                                    F.when(F.col("_first"), F.struct(before.alias("r"), F.lit(True).alias("head")))))
    every = (placed.withColumn("_e", F.explode(spots)).withColumn("_range", F.col("_e.r")).withColumn("_head", F.col("_e.head"))
             .drop("_e", "_own", "_first", "_c", "_fine"))
    w = Window.partitionBy("_range").orderBy("_head", F.col(key).desc_nulls_last(), F.col("_tie"))
    return (every.withColumn("next", F.lead(F.struct(*columns)).over(w))
            .where(~F.col("_head")).drop("_head", "_range"))


def edited_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), fingerprint(text).alias("own"),
                       F.xxhash64(text).alias("_tie"))
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    rows = (with_next(base, ["text", "own"], "doc_id")
            .select("doc_id", n.cast("long").alias("n_chars"), "own", F.col("next.own").alias("other"),
                    F.concat(F.substring(F.col("text"), F.lit(1), n - k),
                             F.substring(F.col("next.text"), F.lit(1), k)).alias("edited"))
            .withColumn("new", fingerprint(F.col("edited"))))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_hex(F.col("own")).alias("fingerprint"), as_hex(F.col("new")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("new")).alias("near_edited"),
                       likeness(F.col("own"), F.col("other")).alias("near_next"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_with_next(read_table(spark, sf_dir))


QUERIES = {"op9_fingerprint": op9_fingerprint}
ORACLE: dict[str, str] = {}
