"""Near-duplicate embeddings by sorted projection passes.

Each pass hashes a vector to the signs of random projections, read as one number, and orders the vectors of a label by
it (ties by a hash of pass and vector). Vectors at a small angle share long prefixes, so near ones come to stand close in some
pass; each vector is compared with the WINDOW before it by cosine in double precision. A pass is a range partitioning
and a sort, which no label or cluster can fill. A window crosses batches within a partition; the first and last rows of every
partition are gathered, in order, and windowed again, so that none is cut short at a border. Pairs verified in a
partition are reduced to a spanning forest before they leave the task; the forests of all passes are joined into
components, so a group of near copies costs links in proportion to its members. Within a component every pair is then
compared, in squares of which each serves both its sides, so each member's count of links is exact there. Squares grow with
the component, so a vector is copied seventeen times, and more often only beyond 131,072 members. That count takes time
with the square of a component's members, as any exact one does.

Equal vectors of a label are one node that stands for all of them. Nulls: a null vector, one that is empty, zero or
holds null or non-finite components, and one with a null label link with nothing; vectors of different lengths do not
link. A vector with a null id has no component and is kept. Equal ids are rows of one vector each, counted apart. Empty
tables give empty results. Vectors of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .shared import attach, components, cut, look_up

#: Passes, projections of each, and how many vectors before it a vector is compared with.
PASSES, BITS, WINDOW = 40, 24, 32
#: Sides of the squares in which a component's members are compared, and squares in a row between these sizes.
SQUARE, LARGEST, CELLS = 128, 8192, 16
#: Members of a square that are compared with the others at a time.
LINES = 512
#: Seed of the projections.
SEED = 1


@functools.cache
def planes(length: int) -> np.ndarray:
    """The random projections of all passes for vectors of a length: (length, PASSES * BITS)."""
    return np.random.default_rng([SEED, length]).standard_normal((length, PASSES * BITS))


def _unit(flat: np.ndarray, length: int) -> np.ndarray:
    """Vectors in double precision, scaled to unit length without overflow."""
    x = flat.astype(np.float64).reshape(-1, length)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, not empty, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _plain(vector: Column, kind: str) -> Column:
    """A vector with -0.0 as 0.0; single precision is kept as it is, which tasks read in double precision."""
    return F.transform(vector, lambda x: F.when(x == 0, F.lit(0).cast(kind)).otherwise(x.cast(kind)))


def nodes(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, label, vector, length, node): every row, its vector null unless it can link.

    Equal vectors of a label have the same node, a 64-bit hash.
    """
    can = F.col("label").isNotNull() & usable(F.col("embedding"))
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.when(can, _plain(F.col("embedding"), kind)).alias("vector"))
    return rows.withColumns({"length": F.size("vector"), "node": F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))})


def _passes(reps: DataFrame) -> DataFrame:
    """Rows (label, length, pass, code, node, vector): a row for each vector and pass."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                side = _unit(_matrix(part.column("vector"), int(length)), int(length)) @ planes(int(length)) > 0
                codes = side.reshape(len(part), PASSES, BITS) @ weights
                columns = [part.column("node"), pa.array(list(codes), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "codes"])

    codes = reps.select("node", "length", "vector").mapInArrow(hashed, "node long, codes array<long>")
    rows = reps.join(codes, "node")
    return rows.select("label", "length", "node", "vector", F.posexplode("codes").alias("pass", "code"))


def _forest(threshold: float, schema: pa.Schema):
    """A task's rows, sorted by label, length, pass and code, to the spanning forest (a, b) of its verified pairs, and its first
    and last rows, WINDOW of each, with their places (part, at)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def given(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        part = TaskContext.get().partitionId()
        last: tuple = ()
        tail_ids, tail = np.zeros(0, dtype=np.int64), None
        heads: list[pa.RecordBatch] = []
        ends: list[tuple[int, pa.RecordBatch]] = []
        seen = 0
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            if seen < WINDOW:
                heads.append(batch.slice(0, WINDOW - seen))
            ends.append((seen, batch))
            seen += len(batch)
            while len(ends) > 1 and seen - ends[1][0] >= WINDOW:
                ends.pop(0)
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "length", "pass")), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            edges = []
            for start, end in zip(cuts, cuts[1:], strict=False):
                if keys[start] != last:
                    last, parent = keys[start], {}
                    tail_ids, tail = np.zeros(0, dtype=np.int64), np.zeros((0, keys[start][1]))
                own = batch.slice(start, end - start)
                ids = np.concatenate([tail_ids, own.column("node").to_numpy()])
                x = np.concatenate([tail, _unit(_matrix(own.column("vector"), last[1]), last[1])])
                old = len(tail_ids)
                for step in range(1, min(WINDOW, len(ids) - 1) + 1):
                    from_ = max(step, old)
                    close = np.einsum("ij,ij->i", x[from_:], x[from_ - step : len(x) - step]) >= threshold
                    for k in np.flatnonzero(close) + from_:
                        a, b = root(int(ids[k])), root(int(ids[k - step]))
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                            edges.append((ids[k], ids[k - step]))
                tail_ids, tail = ids[-WINDOW:], x[-WINDOW:]
            table = np.array(edges, dtype=np.int64).reshape(-1, 2)
            yield given({"a": pa.array(table[:, 0]), "b": pa.array(table[:, 1])}, len(table))
        rest = max(seen - WINDOW, sum(map(len, heads)))  # what is not among the first
        at = 0
        for first, rows in [*((None, h) for h in heads), *ends]:
            if first is not None:
                rows, at = rows.slice(max(0, rest - first)), max(first, rest)
            if len(rows):
                places = {"part": pa.repeat(part, len(rows)), "at": pa.array(np.arange(at, at + len(rows)))}
                yield given({c: rows.column(c) for c in rows.schema.names} | places, len(rows))
            at += len(rows)

    return walk


def _linked(sorted_: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) of rows that are dealt out by ranges and sorted; the rows at the ranges' borders, some for each range, meet
    again by label and pass, in their order."""
    columns = ["label", "length", "pass", "node", "vector"]
    kinds = {f.name: f.dataType.simpleString() for f in sorted_.select(*columns).schema}
    out = ", ".join(["a long", "b long", *[f"{c} {k}" for c, k in kinds.items()], "part int", "at long"])
    schema = to_arrow_schema(sorted_.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), *columns, F.lit(0).alias("part"), F.lit(0).cast("long").alias("at")).schema)
    schema = pa.schema([f.with_nullable(True) for f in schema])
    found = cut(sorted_.select(*columns).mapInArrow(_forest(threshold, schema), out))
    keys = ["label", "length", "pass"]
    border = found.where("a IS NULL").repartition(*keys).sortWithinPartitions(*keys, "part", "at").select(*columns)
    again = border.mapInArrow(_forest(threshold, schema), out)
    return found.unionByName(again).where("a IS NOT NULL").select("a", "b")


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, links): for each member (component, node, length, vector, n), the vectors of other members that are
    near, copies counted. Members meet in squares on and above the diagonal; a square gives sums for both its sides."""
    side = F.greatest(F.lit(SQUARE), F.least(F.lit(LARGEST), F.count("*") / CELLS))
    sizes = cut(members.groupBy("component").agg(F.ceil(F.count("*") / side).cast("int").alias("cells")))
    rows = attach(members, sizes, ["component"])
    item = F.struct("node", "n", "vector")
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    rows = rows.select("component", "length", "cells", own.alias("own"), item.alias("x"))
    left = rows.select("component", "length", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("cells") - 1)).alias("j"), "x", F.lit(True).alias("l"))
    right = rows.select("component", "length", F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), "x", F.lit(False).alias("l"))
    squares = left.union(right).groupBy("component", "length", "i", "j").agg(
        F.collect_list(F.when(F.col("l"), F.col("x"))).alias("u"), F.collect_list(F.when(~F.col("l"), F.col("x"))).alias("v")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            u, v = batch.column("u").flatten(), batch.column("v").flatten()
            ids, sums = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            if len(u) and len(v):
                length, diagonal = batch.column("length")[0].as_py(), batch.column("i")[0] == batch.column("j")[0]
                (a, n), (b, m) = ((z.field("node").to_numpy(), z.field("n").to_numpy()) for z in (u, v))
                x, y = (_unit(_matrix(z.field("vector"), length), length) for z in (u, v))
                below = np.zeros(len(b), dtype=np.int64)
                for k in range(0, len(a), LINES):
                    # the dot products as the passes take them, so that both agree on a pair
                    near = np.einsum("ik,jk->ij", x[k : k + LINES], y) >= threshold
                    near &= a[k : k + LINES, None] != b
                    ids.append(a[k : k + LINES])
                    sums.append(near @ m)
                    below += n[k : k + LINES] @ near
                if not diagonal:
                    ids.append(b)
                    sums.append(below)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(sums))], names=["node", "links"])

    found = squares.select("length", "i", "j", "u", "v").mapInArrow(compare, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every row of `vectors` (vec_id, embedding, label)."""
    every = nodes(vectors)
    reps = cut(
        every.where("node is not null")
        .groupBy("node")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("length").alias("length"), F.first("vector").alias("vector"))
    )
    split = _passes(reps)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "length", "pass", "code", "tie"]
    sorted_ = split.withColumn("tie", F.xxhash64("pass", "node")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    found = components(_linked(sorted_, threshold))
    members = cut(found.join(reps, "node").select("component", "node", "length", "vector", "n"))
    links = _counted(members, threshold)
    named = reps.select("node", "n", "vec_id").join(found, "node", "left").join(links, "node", "left")
    named = cut(named.select("node", "n", "vec_id", F.coalesce("component", "node").alias("part"), F.coalesce("links", F.lit(0)).alias("links")))
    least = cut(named.groupBy("part").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("rows")))
    of = look_up(named, least, "part", "rows", named.count())
    of = cut(of.select("node", F.col("n").alias("rows"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id"))
    held = cut(every.select("vec_id", "node"))
    own = F.coalesce("component_id", "vec_id")
    return (
        look_up(held, of, "node", "rows", held.count())
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("vec_id").isNotNull(), own).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
