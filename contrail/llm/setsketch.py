"""Near-duplicate documents by SetSketch registers, banded, estimated jointly and verified on full shingle sets.

A document's set is its distinct word shingles. Each of M registers holds the least of the set's hashes under its own
hash function, read as an exponential variate and put on an exponential scale of base B: floor(1 - log_B x), truncated
to 0..Q+1. Registers of a union are the registers' maxima, and two sets agree in a register about as often as their
Jaccard index says. Equal sequences of words (by 128 bits) are one class, of which one document is worked on. Classes that agree in a
band of ROWS registers meet in a bucket.

First each class meets the bucket's least member and a member drawn for the band; the joint likelihood of the registers
and the exact set sizes estimates each pair, and the TRIED likeliest of each class are verified on the full sets. The
links found give components. Then only buckets that hold several components are left. In these all pairs between
components are estimated, in squares of registers, and those that may link hold clusters together; within a cluster all
pairs between components are tried on full sets, likeliest first, until they are joined or none is left. Squares give
spanning links only, so a dense group costs rows in proportion to its members, and they are bounded by members and by the
hashes of their sets, so that long texts make more squares, not larger ones. No candidate pair is lost, and nothing is
sampled or capped.

Nulls: a null text, or one without words, has an empty set and no link. A text of fewer words than a shingle is one
shingle, its whole sequence. A document with a null id is in no group and kept. Rows that repeat an id are documents of
their own by their texts: those of one text are copies, and share all that is said of it. Equally likely pairs are tried in the order
of their ids. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, attach, compact, components, cut, lean, look_up, salted_join

#: The scale of the registers: base, rate and largest value.
B, A, Q = 1.001, 20.0, 65_534
#: Bands and their registers.
BANDS, ROWS = 25, 5
M = BANDS * ROWS
#: Pairs of a class that are verified before the first components.
TRIED = 2
#: A pair is verified if its estimate is within this of the threshold: four standard errors of M registers.
MARGIN = 0.14
#: Members of a bucket up to which its pairs are listed; fuller buckets are compared in squares.
FEW = 8
#: Sides of the squares in which members of full buckets are compared, squares in a row between these sizes, and hashes of
#: the sets on a side.
LEAST, SQUARE, CELLS, HASHES = 64, 512, 16, 1 << 20
#: Documents that a task sketches at a time.
LOT = 256


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        n = max(1, len(h) - width + 1)
        out = np.full(n, min(len(h), width), dtype=np.uint64)
        for i in range(min(width, len(h))):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the registers' hash functions, from a fixed seed."""
    rng = np.random.default_rng(20_200_213)
    return rng.integers(0, 2**63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, M, dtype=np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set of at least one hash."""
    odd, plus = _functions()
    least = np.full(M, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 1024):
            part = hashes[i : i + 1024, None] * odd
            part ^= part >> np.uint64(29)
            part *= odd[::-1]
            part += plus
            np.minimum(least, part.min(axis=0), out=least)
    return on_scale(least)


def on_scale(least: np.ndarray) -> np.ndarray:
    """Least uniform hashes as register values."""
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / A
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(above: np.ndarray, below: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard indices, given how many registers of the first set are above and below the second's, and sizes.

    A register of the first is above with probability p(u - vJ) and below with p(v - uJ), where u and v are the shares
    of the sizes and p(x) = -log_B(1 - x (B - 1) / B); the log likelihood is concave in J and searched by thirds.
    """
    u = n1 / (n1 + n2)
    v = 1 - u
    level = M - above - below

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)

    def fit(j: np.ndarray) -> np.ndarray:
        up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return above * np.log(up) + below * np.log(down) + level * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(32):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = fit(a) > fit(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def _digest(text: str) -> bytes | None:
    """128 bits that stand for a text's normalised words, or None without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, digest, n_shingles, registers): digest and sketch of each text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, LOT) for b in batches for i in range(0, b.num_rows, LOT)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sets = [shingles(t, width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([_digest(t) for t in texts], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "digest", "n_shingles", "registers"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketch, "doc_id long, digest binary, n_shingles long, registers binary"
    )


def _banded(classes: DataFrame) -> DataFrame:
    """Rows (id, bucket): a bucket is the hash of a band's number and registers."""
    bands = [F.xxhash64(F.lit(b), F.substring("registers", 2 * b * ROWS + 1, 2 * ROWS)) for b in range(BANDS)]
    return classes.select("id", F.explode(F.array(*bands)).alias("bucket"))


def _times(rows: DataFrame, key: str) -> DataFrame:
    """How many rows bear each key."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def _likely(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (id, other) whose estimate allows the threshold, with `likeness`."""

    def compare(lots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots:
            one, two = (
                np.frombuffer(b"".join(lot.column(c).to_pylist()), dtype=np.uint16).reshape(-1, M) for c in ("r1", "r2")
            )
            n1, n2 = (lot.column(c).to_numpy().astype(float) for c in ("n1", "n2"))
            j = estimate((one > two).sum(axis=1), (one < two).sum(axis=1), n1, n2)
            keep = pa.array(j >= threshold / 100 - MARGIN)
            columns = [lot.column("id"), lot.column("other"), pa.array(j)]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], names=["id", "other", "likeness"])

    one = classes.select("id", F.col("n").alias("n1"), F.col("registers").alias("r1"))
    two = classes.select(F.col("id").alias("other"), F.col("n").alias("n2"), F.col("registers").alias("r2"))
    fits = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * threshold
    return salted_join(pairs.join(one, "id"), two, "other", "id", _times(pairs, "other")).where(fits).select("id", "other", "n1", "n2", "r1", "r2").mapInArrow(
        compare, "id long, other long, likeness double"
    )


def _full_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Rows (c, s): the full sets of the classes in `ids` (id), read again from the text of each class's first document."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, LOT) for b in batches for i in range(0, b.num_rows, LOT)):
            rows = [(t or "", d, c) for t, d, c in zip(*(batch.column(x).to_pylist() for x in ("text", "digest", "id")), strict=True)]
            rows = [(t, c) for t, d, c in rows if _digest(t) == d]  # an id may bear several texts
            sets = [shingles(t, width).view(np.int64) for t, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for _, c in rows], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["c", "s"]
            )

    ends = compact(ids.distinct().join(classes.select("id", "doc_id", "digest"), "id"))
    few = ends.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ends) if few else ends, "doc_id")
    return compact(texts.select("text", "digest", "id").mapInArrow(full, "c long, s array<long>").dropDuplicates(["c"]))


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """Those of the pairs (a, b) of classes with 100 * intersection >= threshold * union, on full sets."""
    sets = _full_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), classes, docs, width)
    one = sets.select(F.col("c").alias("a"), F.col("s").alias("s1"))
    two = sets.select(F.col("c").alias("b"), F.col("s").alias("s2"))
    first = salted_join(pairs, one, "a", "b", _times(pairs, "a"))
    sized = salted_join(first, two, "b", "a", _times(pairs, "b")).select(
        "a", "b", F.size(F.array_intersect("s1", "s2")).alias("i"), (F.size("s1") + F.size("s2")).alias("t")
    )
    return compact(sized.where(F.col("i") * 100 >= (F.col("t") - F.col("i")) * threshold).select("a", "b"))


def _opened(met: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (bucket, id, part, low, members): the members of the buckets that still hold several components."""
    placed = met.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("part")
    )
    several = placed.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("id").alias("low"), F.min("part").alias("p"), F.max("part").alias("q")
    )
    return compact(placed.join(several.where("p <> q").select("bucket", "low", "members"), "bucket"))


def _few(rows: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) between components in buckets of at most FEW members, whose estimate allows the threshold."""
    own = rows.join(classes.select("id", "n", "registers"), "id")
    held = own.groupBy("bucket").agg(F.collect_list(F.struct("id", "part", "n", "registers")).alias("x"))

    def compare(lots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in (b.slice(i, 1024) for b in lots for i in range(0, b.num_rows, 1024)):
            lists = lot.column("x")
            ids, parts, n, regs = _columns(lists.flatten())
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            pairs = [(i, j) for s, e in zip(at, at[1:], strict=False) for i in range(s, e) for j in range(i + 1, e)]
            x, y = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
            fits = (parts[x] != parts[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * threshold)
            x, y = x[fits], y[fits]
            one, two = regs[x], regs[y]
            j = estimate((one > two).sum(axis=1), (one < two).sum(axis=1), n[x].astype(float), n[y].astype(float))
            x, y = x[j >= threshold / 100 - MARGIN], y[j >= threshold / 100 - MARGIN]
            yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], names=["a", "b"])

    return held.select("x").mapInArrow(compare, "a long, b long").distinct()


def _squares(rows: DataFrame, by: str, item: Column, hashes: Column) -> DataFrame:
    """Rows (u, v) of lists of `item`: the members of each group (column `by`) outside its largest part (column part),
    u, and all of its members, v, in squares that cover all pairs of the two, with about SQUARE members and HASHES
    `hashes` on a side at most."""
    sizes = rows.groupBy(by, "part").agg(F.count("*").alias("n"), F.sum(hashes).alias("h"))
    side = lambda n: F.greatest(F.lit(LEAST), F.least(F.lit(SQUARE), n / CELLS))
    cells = lambda n, h: F.ceil(F.greatest(n / side(n), h / HASHES)).cast("int")
    grid = compact(
        sizes.groupBy(by)
        .agg(F.count("*").alias("parts"), F.sum("n").alias("_n"), F.sum("h").alias("_h"), F.max(F.struct("n", "part", "h")).alias("top"))
        .where("parts > 1")
        .select(
            by,
            F.col("top.part").alias("largest"),
            cells(F.col("_n"), F.col("_h")).alias("wide"),
            cells(F.col("_n") - F.col("top.n"), F.col("_h") - F.col("top.h")).alias("high"),
        )
    )
    met = attach(rows, grid, [by]).where("largest is not null")
    own = F.xxhash64("id")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = met.where("part <> largest").select(
        by, F.pmod(own, F.col("high")).cast("int").alias("i"), upto("wide").alias("j"), item.alias("x"), F.lit(True).alias("l")
    )
    right = met.select(
        by, upto("high").alias("i"), F.pmod(own, F.col("wide")).cast("int").alias("j"), item.alias("x"), F.lit(False).alias("l")
    )
    lists = [F.collect_list(F.when(c, F.col("x"))).alias(n) for c, n in ((F.col("l"), "u"), (~F.col("l"), "v"))]
    return left.union(right).groupBy(by, "i", "j").agg(*lists).select("u", "v")


def _many(rows: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """For fuller buckets, a spanning forest (a, b) over ids of the pairs between components whose estimate allows the
    threshold: at most one row for each member of a square, and the ids of every such pair are connected."""
    own = rows.join(classes.select("id", "n", "registers"), "id")
    squares = _squares(own, "bucket", F.struct("id", "part", "n", "registers"), F.lit(0))
    return squares.mapInArrow(_within(threshold, False), "a long, b long").distinct()


def _within(threshold: int, verify: bool):
    """A task's squares to the links in them, by estimate alone or verified on full sets."""

    def compare(lots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in (b.slice(i, 1) for b in lots for i in range(b.num_rows)):
            u, v = lot.column("u").flatten(), lot.column("v").flatten()
            links = _joined(u, v, threshold, verify) if len(u) and len(v) else []
            table = np.array(links, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], names=["a", "b"])

    return compare


def _columns(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
    """(id, part, n, registers) of an array of structs."""
    plain = [rows.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "part", "n")]
    flat = np.frombuffer(b"".join(rows.field("registers").to_pylist()), dtype=np.uint16)
    return (*plain, flat.reshape(-1, M))


def _clustered(members: DataFrame, classes: DataFrame, docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """Verified links (a, b) that join the components within each cluster; `members` has (id, part, cluster).

    A square tries a member's likeliest pairs first, skips those that its links have joined meanwhile, and gives its
    links only.
    """
    sets = _full_sets(members.select("id"), classes, docs, width).withColumnRenamed("c", "id")
    rows = members.join(classes.select("id", "n", "registers"), "id").join(sets, "id")
    squares = _squares(rows, "cluster", F.struct("id", "part", "n", "registers", "s"), F.col("n"))
    return compact(squares.mapInArrow(_within(threshold, True), "a long, b long"))


def _joined(u: pa.StructArray, v: pa.StructArray, threshold: int, verify: bool) -> list[tuple[int, int]]:
    """Links between rows of u and v; verified on full sets, one for each two components that they join, or by estimate
    alone, a forest of ids, as an estimate between two components does not stand for the other pairs between them."""
    (ui, up, un, ur), (vi, vp, vn, vr) = _columns(u), _columns(v)
    uk, vk = (up, vp) if verify else (ui, vi)
    us, vs = (u.field("s"), v.field("s")) if verify else (None, None)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k in range(len(ui)):
        fits = np.flatnonzero((vp != up[k]) & (np.minimum(vn, un[k]) * 100 >= np.maximum(vn, un[k]) * threshold))
        above, below = (ur[k] > vr[fits]).sum(axis=1), (ur[k] < vr[fits]).sum(axis=1)
        j = estimate(above, below, np.full(len(fits), float(un[k])), vn[fits].astype(float))
        likely = fits[np.argsort(-j, kind="stable")][: int((j >= threshold / 100 - MARGIN).sum())]
        mine = us[k].values.to_numpy() if verify else None
        for t in likely:
            if root(int(uk[k])) == root(int(vk[t])):
                continue
            both = len(np.intersect1d(mine, vs[int(t)].values.to_numpy(), assume_unique=True)) if verify else 0
            if not verify or both * 100 >= threshold * (un[k] + vn[t] - both):
                parent[root(int(uk[k]))] = root(int(vk[t]))
                out.append((int(ui[k]), int(vi[t])))
    return out


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) for every row of `docs`: groups of texts that share at least
    `threshold` per cent of their joint shingles of `width` words, directly or through others."""
    return grouped(docs, width, threshold).drop("digest")


def deduplicate(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """`docs` with one document of each group of near-duplicates, the one with the smallest id.

    The ids to drop are broadcast while they are few, else joined by id. Of rows that repeat an id, each text counts for
    itself, and of rows with equal id and text the least stays. Rows without an id or without words all stay.
    """
    found = cut(grouped(docs, width, threshold))
    ids = cut(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("out")).where("n > 1 or out > 0"))
    gone, twice = ids.where("n = 1").select("doc_id"), ids.where("n > 1").select("doc_id")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rest = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    if twice.isEmpty():
        return rest

    @F.pandas_udf("binary")
    def digest(lots: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lot in lots:
            yield pd.Series([_digest(t or "") for t in lot], dtype="object")

    again = rest.join(twice, "doc_id", "left_semi").select(F.col("doc_id").cast("long").alias("_id"), digest("text").alias("_d"), F.struct(*docs.columns).alias("_row"))
    stay = found.join(twice, "doc_id", "left_semi").where("kept and digest is not null").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_d")).distinct()
    least = again.join(stay, ["_id", "_d"]).groupBy("_id", "_d").agg(F.min("_row").alias("_row"))
    empty = again.where("_d is null").select("_row")
    return rest.join(twice, "doc_id", "left_anti").select(*docs.columns).union(least.select("_row").union(empty).select("_row.*"))


def grouped(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """As `near_duplicates`, with `digest`, which stands for the row's normalised words."""
    rows = compact(_sketched(lean(docs), width))
    known = rows.where("digest is not null and doc_id is not null")
    # numbered as they are written to the checkpoint, which every later step reads
    classes = compact(
        known.groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"), F.max(F.struct("n_shingles", "registers")).alias("x"))
        .select(F.monotonically_increasing_id().alias("id"), "digest", "doc_id", "rows", F.col("x.n_shingles").alias("n"), F.col("x.registers").alias("registers"))
    )
    banded = _banded(classes)
    draw = F.min(F.struct(F.xxhash64("id", "bucket").alias("h"), F.col("id").alias("id")))
    shared = compact(
        banded.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("id").alias("low"), draw.alias("drawn"))
        .where("n > 1")
        .select("bucket", "n", "low", F.col("drawn.id").alias("drawn"))
    )
    met = compact(salted_join(banded, shared.drop("n"), "bucket", "id", shared))
    heads = compact(met.select("id", F.explode(F.array("low", "drawn")).alias("other")).where("id <> other").distinct())
    likely = compact(_likely(heads, classes, threshold))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("likeness"), "other"))
    ends = [F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")]
    tried = compact(likely.withColumn("_k", rank).where(F.col("_k") <= TRIED).select(*ends).distinct())
    first = _linked(tried, classes, docs, width, threshold)
    parts = components(first)
    opened = _opened(met.select("bucket", "id"), parts)
    full = F.col("members") > FEW
    maybe = _few(opened.where(~full), classes, threshold).union(_many(opened.where(full), classes, threshold))
    clusters = components(maybe).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    members = compact(opened.select("id", "part").distinct().join(clusters, "id"))
    second = _clustered(members, classes, docs, width, threshold)
    parts = components(first.union(second))
    named = cut(
        classes.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
            "digest", "doc_id", "rows", F.coalesce("component", "id").alias("part")
        )
    )
    least = cut(named.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members")))
    of = cut(look_up(named, least, "part", "members", named.count()).select("digest", "rows", "component_id"))
    own = F.coalesce("component_id", "doc_id")
    held = rows.select("doc_id", "n_shingles", "digest")
    return (
        look_up(held, of, "digest", "rows", held.count())
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), "digest")
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", "digest")
    )
