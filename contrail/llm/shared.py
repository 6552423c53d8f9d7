"""Helpers of the training-data operators: cut lineage, skew-safe look-ups, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cuts import cut

#: A look-up table of at most this many rows is broadcast; a larger one is joined by salted keys.
BROADCAST_ROWS = 100_000
#: Rows of a partition of a compact table.
PART_ROWS = 20_000
#: Edges that a task holds at a time.
EDGE_ROWS = 200_000
#: Copies of a row that one task writes out.
RUN = 100_000
#: Copies of a look-up row when its join is salted.
SALTS = 16


def lean(df: DataFrame, rows: int = 1000) -> DataFrame:
    """`df`, with batches of at most `rows` rows between the JVM and Python workers from now on, so that batches of long
    texts stay small on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df.sparkSession.conf.set(name, str(min(rows, int(df.sparkSession.conf.get(name, "10000")))))
    return df


def compact(df: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """As `cut`, in partitions of about `rows` rows: a small table costs few files in every later shuffle."""
    kept = cut(df)
    return kept.coalesce(1 + kept.count() // rows)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the tables of a directory."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, *made: str) -> DataFrame:
    """`df` less its columns that bear the names an operator is about to make, whatever their case."""
    taken = {m.lower() for m in made}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def attach(big: DataFrame, small: DataFrame, keys: list[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """`big` left-joined to the look-up table `small` (one row for each null-safe key).

    `small` must be cheap to read again, such as a checkpoint. It is counted first: up to `most` rows are broadcast;
    a longer table is copied SALTS times and joined by key and salt, so that a hot key is spread over SALTS tasks.
    """
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    right = small.withColumnsRenamed(names)
    met = None
    for k, n in names.items():
        same = big[k].eqNullSafe(right[n])
        met = same if met is None else met & same
    if small.limit(most + 1).count() <= most:
        return big.join(F.broadcast(right), met, "left").drop(*names.values())
    right = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = big.withColumn("_salt_l", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    met = left["_salt_l"] == right["_salt_r"]
    for k, n in names.items():
        met = met & left[k].eqNullSafe(right[n])
    return left.join(right, met, "left").drop("_salt_l", "_salt_r", *names.values())


def look_up(big: DataFrame, small: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """`big` left-joined to `small`, which has one row for each key, and `rows`, how many rows of `big` bear it.

    Keys of more than a thousandth of all `total` rows, fewer than a thousand, are broadcast; all others meet by key, no
    task getting much more than that share of them; rows without a key meet nothing. Both sides must be cheap to read again.
    """
    hot = F.col(rows) * 1000 > total
    values = [c for c in small.columns if c not in (key, rows)]
    met = big.join(F.broadcast(small.where(hot).select(key, *values, F.lit(True).alias("_hot"))), key, "left")
    first = met.where("_hot").select(*big.columns, *values)
    rest = met.where(F.col("_hot").isNull() & F.col(key).isNotNull()).select(*big.columns)
    rest = rest.join(small.where(~hot).select(key, *values), key, "left").select(*big.columns, *values)
    none = big.where(F.col(key).isNull()).select(*big.columns, *[F.lit(None).cast(small.schema[v].dataType).alias(v) for v in values])
    return first.union(rest).union(none)


def salted_join(big: DataFrame, small: DataFrame, key: str, by: str, counts: DataFrame) -> DataFrame:
    """`big` joined to `small`, which has one row for each key; rows that meet none go. `counts` (key, n) says how many rows of
    `big` bear each key and must be cheap to read again.

    Keys of more than a thousandth of all rows, fewer than a thousand, are told to both sides by broadcast: as many copies
    of their rows of `small` are dealt out as they hold thousandths, and each row of `big` meets one of them, by the hash
    of its column `by`, so that a task that runs again deals as before. So no task gets much more than its share, and rows of `small`, however long, are not broadcast.
    """
    total = counts.agg(F.sum("n")).first()[0] or 1
    hot = cut(counts.where(F.col("n") * 1000 > total).select(key, F.ceil(F.col("n") * 1000 / total).cast("int").alias("_copies")))
    if hot.isEmpty():
        return big.join(small, key)
    copies = F.coalesce("_copies", F.lit(1))
    left = big.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.xxhash64(by), copies).cast("int")).drop("_copies")
    right = small.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return left.join(right, [key, "_salt"]).drop("_salt")


def written_out(rows: DataFrame, first: Column, times: str, name: str, most: int) -> DataFrame:
    """Each of `rows` as often as `times` says, numbered on from `first` as `name`; `most` is the greatest `times`.

    Copies are written out by runs of RUN, which are dealt over the tasks where a row has several, so that none writes out
    all copies of one row, and no list of numbers is longer than a run.
    """
    n = F.col(times)
    if most <= RUN:
        return rows.withColumn(name, F.explode(F.sequence(first, first + n - 1))).drop(times)
    runs = rows.withColumns({"_first": first, "_run": F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / RUN)))})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that few runs are not put together
    dealt = runs.repartition(parts, *[c for c in runs.columns if c != "_first"])
    start = F.col("_first") + F.col("_run") * RUN
    end = F.least(start + RUN, F.col("_first") + n) - 1
    return dealt.withColumn(name, F.explode(F.sequence(start, end))).drop(times, "_first", "_run")


def count_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(*columns: Column) -> Column:
    """A double in [0, 1) from a 64-bit hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (a, b) to stars around the smallest node of each of its components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = np.array([(x, root(x)) for x in parent if root(x) != x], dtype=np.int64).reshape(-1, 2)
    for i in range(0, len(found), 10_000):
        part = found[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])


def components(edges: DataFrame, most_rounds: int = 64, rows: int = EDGE_ROWS) -> DataFrame:
    """Connected components of `edges` (a, b long): rows (node, component), component the smallest node reachable.

    Each task turns its edges, about `rows` of them, into stars around the smallest nodes that they reach. With several
    tasks, rounds of the large-star and small-star operations and of such stars join them until nothing changes. Every
    round is a grouped minimum and a join by node, both safe on hubs: the minimum combines before it shuffles, and
    adaptive execution may split the join. Rounds are logarithmic in the nodes for the graphs met here.
    """
    state = _contracted(edges.where("a <> b").select("a", "b"), rows)
    before = None
    for _ in range(most_rounds):
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() if state.rdd.getNumPartitions() > 1 else before
        if now == before:
            break
        before = now
        both = state.select("a", "b").union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above the node move to the smallest neighbour
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        ).distinct()
        # small star: the neighbours below the node, and the node, move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "a", "m")
        joined = small.select(F.col("x").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        state = _contracted(joined.where("a <> b").distinct(), rows)
    else:
        raise RuntimeError(f"components did not settle within {most_rounds} rounds")
    nodes = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)


def _contracted(edges: DataFrame, rows: int) -> DataFrame:
    return cut(compact(edges, rows).mapInArrow(_stars, "a long, b long"))
