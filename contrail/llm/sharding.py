"""Sharding by a keyed Feistel permutation of global row numbers, with cycle walking.

Rows get global numbers 0..N-1 in an order that only their values fix; a permutation of 0..N-1 shuffles the numbers;
the permuted number alone gives shard (remainder) and slot (quotient), so a shard's slots have no gaps, counts differ
by one at most, and any row's place can be computed without moving data.

Nulls: a null id is a value like any other, a null text has no bytes and checksum 0. Repeated rows are numbered one
after the other. Very long texts count by their bytes. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, cut, written_out

#: Half rounds of the permutation.
HALF_ROUNDS = 8
#: Steps of the cycle walk. Fewer than one number in the square root of N lies outside, so a walk this long does not occur
#: but by an error, which is raised.
WALK = 64
#: Distinct rows for each block of the numbering.
BLOCK_ROWS = 50_000


def permuted(number: Column, total: Column, key: int) -> Column:
    """Where a keyed permutation of 0..total-1 sends `number`; SQL functions only.

    The numbers are laid out as (high, low) in a rectangle of a rows and b columns, a*b >= total, a*b - total < a.
    Half rounds add a hash of one half to the other, modulo its side; the permutation of the rectangle is walked on
    until it comes back below the total.
    """
    a = F.ceil(F.sqrt(total.cast("double"))).cast("long")
    b = F.ceil(total / a).cast("long")

    def half(state: Column, k: Column) -> Column:
        return F.struct(
            state["v"].alias("u"),
            F.pmod(state["u"] + F.pmod(F.xxhash64(k, state["v"]), state["mu"]), state["mu"]).alias("v"),
            state["mv"].alias("mu"),
            state["mu"].alias("mv"),
        )

    keys = F.array(*[F.lit(key * 1_000_003 + i) for i in range(HALF_ROUNDS)])

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("u"), F.pmod(x, b).alias("v"), a.alias("mu"), b.alias("mv"))
        return F.aggregate(keys, start, half, lambda s: s["u"] * b + s["v"])

    steps = F.sequence(F.lit(2), F.lit(WALK))
    out_of_steps = F.raise_error(F.lit("a cycle walk did not come back")).cast("long")
    return F.aggregate(steps, once(number), lambda x, _: F.when(x < total, x).otherwise(once(x)), lambda x: F.when(x < total, x).otherwise(out_of_steps))


def numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """`rows` with `number` (0..N-1, fixed by the values in `columns`) and `total`.

    Equal rows are counted first, so no value fills a block; blocks are dealt by hash, numbered by a window each, and
    offset by the blocks before. The list of blocks (N / BLOCK_ROWS of them) is the only thing that meets in one task.
    """
    counted = cut(rows.groupBy(*columns).agg(F.count("*").alias("_n")))
    kinds, most = counted.agg(F.count("*"), F.coalesce(F.max("_n"), F.lit(0))).first()
    blocks = max(1, -(-kinds // BLOCK_ROWS))
    placed = counted.withColumn("_block", F.pmod(F.xxhash64(*columns), F.lit(blocks)))
    sums = placed.groupBy("_block").agg(F.sum("_n").alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(
        sums.select(
            "_block",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
            F.sum("_rows").over(Window.partitionBy()).alias("total"),
        )
    )
    within = Window.partitionBy("_block").orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    placed = placed.withColumn(
        "_first", F.coalesce(F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    ranked = attach(placed, offsets, ["_block"]).select(*columns, "total", "_n", (F.col("_offset") + F.col("_first")).alias("_at"))
    return written_out(ranked, F.col("_at"), "_n", "number", most).select(*columns, "total", "number")


def shard(docs: DataFrame, shards: int = 24, key: int = 20_240_229) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, number, shard, slot): a shuffle of all rows over `shards` shards."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    to = permuted(F.col("number"), F.col("total"), key)
    return (
        numbered(rows, ["doc_id", "size", "text_crc32"])
        .withColumn("_to", to)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "number",
            F.pmod("_to", F.lit(shards)).cast("int").alias("shard"),
            F.floor(F.col("_to") / shards).cast("long").alias("slot"),
        )
    )
