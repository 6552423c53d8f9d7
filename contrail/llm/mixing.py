"""Mixing sources to target weights by entropy balancing.

Rates r_i >= 0 of the documents solve: least sum of size_i * (r_i log(r_i / q_i) - r_i + q_i) under r_i <= MOST and
token constraints: each source's words meet its target exactly, and the words of each length band stay near the band's
words in the corpus (a quadratic price, SOFT, for what is missing, so that every input has a solution). The convex dual
has a multiplier for each source and each band, and the solution is an exponential tilt of the base rates,
r_i = min(MOST, q_i * exp(m_source + m_band)). Documents of one source, band and base rate share a rate, so sums over
documents are sums over such cells, grouped once. Newton steps on the bands' multipliers then run as Spark jobs: in each,
every source solves its own multiplier within its row, and grouped sums over the sources give the gradient and the Hessian
(the Schur complement), at most 32 by 32 numbers, which are all that the driver sees.

Rates become copies: the whole part is taken outright, and the fractions are drawn in the order of u_i / fraction_i (u_i
a hash of the document) until the source's budget is spent; the document at the edge gives only the words still missing.

Nulls: a null source is a source of its own, last in order; a null text has size 0 and is never taken; a null id is a
value. Repeated rows tie and share what is left at the edge. Very long texts fall into a high band and may be taken in
part. An empty table gives an empty result, and a corpus without words takes none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cuts import row_numbers
from .shared import attach, compact, count_words, cut, unit_hash

#: A document is taken at most so many times, and a source's target is at most so many times its size.
MOST = 3.0
#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Base rates are rounded to this many steps for each doubling, between 2**-10 and 2**10.
STEPS = 16
NEWTON_STEPS = 60
#: Newton steps on the bands' multipliers, and the residual (as a share of all words) at which they end.
ROUNDS, RESIDUAL = 40, 1e-7
#: A band may miss its words by this share for each unit of its multiplier.
SOFT = 0.02
#: Seed of the draw.
SEED = 11


def sized(docs: DataFrame, base_rate: Column | None = None) -> DataFrame:
    """Rows (doc_id, source, size, base, band): words of each text, its base rate on the grid, and its length band, the
    power of four below its size."""
    base = F.lit(1.0) if base_rate is None else F.coalesce(base_rate.cast("double"), F.lit(1.0))
    grid = F.round(F.log2(F.greatest(F.lit(2.0**-10), F.least(F.lit(2.0**10), base))) * STEPS)
    rows = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.pow(F.lit(2.0), grid / STEPS).alias("base"))
    return rows.withColumn("band", band_of(F.col("size")))


def band_of(size: Column) -> Column:
    """0 to 31: floor(log4(size)), and 0 for no words."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) / 2).cast("int")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Rows (source, source_size, target): shares of all words by weight, none above MOST times the source's size.

    The excess is shared again until no source is above its limit: each round is two sums over the sources, and the
    level can only rise. Ranks come from ranges of sources, so no task holds them all.
    """
    ranked = row_numbers(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    known = cut(ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * F.lit(MOST)).alias("_limit")))
    whole = known.agg(F.sum("source_size").alias("t"), F.sum("_w").alias("w")).first()
    total, level, capped = float(whole["t"] or 0), float(whole["t"] or 0) / (whole["w"] or 1.0), -1
    while True:
        over = F.col("_w") * F.lit(level) > F.col("_limit")
        now = known.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("_limit"))).alias("limits"), F.sum(F.when(~over, F.col("_w"))).alias("free")).first()
        if now["n"] == capped or not now["free"]:
            break
        capped, level = now["n"], (total - (now["limits"] or 0.0)) / now["free"]
    return known.select("source", "source_size", F.least(F.col("_limit"), F.col("_w") * F.lit(level)).alias("target"))


def multipliers(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` with `multiplier`, the dual solution of each source, `tilts`, that of each band as a map (the same in
    every row), and `documents`, the source's rows that have words.

    A source's row holds its words by band and base rate, at most 32 * (20 * STEPS + 1) cells.
    """
    cells = (
        sizes.where("size > 0")
        .groupBy("source", "band", "base")
        .agg(F.sum("size").cast("double").alias("t"), F.count("*").alias("n"))
        .groupBy("source")
        .agg(F.array_sort(F.collect_list(F.struct("band", "base", "t"))).alias("cells"), F.sum("n").alias("documents"))
        .withColumnRenamed("source", "_s")
    )
    rows = compact(wanted.join(cells, wanted["source"].eqNullSafe(cells["_s"]), "left").drop("_s"))
    each = rows.select(F.explode("cells").alias("c")).groupBy("c.band").agg(F.sum("c.t").alias("t")).collect()  # a row a band
    words = {r["band"]: r["t"] for r in each}
    total = sum(words.values())
    tilts, step, last = dict.fromkeys(words, 0.0), dict.fromkeys(words, 0.0), float("inf")
    for _ in range(ROUNDS if words else 0):
        got, curve = _sums(_solved(rows, tilts))
        miss = {k: t - got.get(k, 0.0) - SOFT * t * tilts[k] for k, t in words.items()}
        size = max(map(abs, miss.values()))
        if size <= RESIDUAL * total:
            break
        if size > last:  # the step was too long where rates meet their cap: go half of it back
            step = {k: x / 2 for k, x in step.items()}
            tilts = {k: tilts[k] - step[k] for k in tilts}
            last *= 1.1
            continue
        bands = sorted(words)
        square = [[curve.get((k, j), 0.0) + (SOFT * words[k] if j == k else 0.0) for j in bands] for k in bands]
        moves = dict(zip(bands, linear(square, [miss[k] for k in bands]), strict=True))
        last, step = size, {k: max(-1.0, min(1.0, moves[k])) for k in bands}
        tilts = {k: tilts[k] + step[k] for k in bands}
    return _solved(rows, tilts).select(
        "source", "source_size", "target", F.coalesce("documents", F.lit(0)).alias("documents"), "multiplier", _table(tilts).alias("tilts")
    )


def _table(tilts: dict[int, float]) -> Column:
    pairs = [x for k, v in sorted(tilts.items()) for x in (F.lit(k), F.lit(v))]
    return F.create_map(*pairs) if pairs else F.expr("cast(map() as map<int, double>)")


def _solved(rows: DataFrame, tilts: dict[int, float]) -> DataFrame:
    """`rows` with `multiplier`, each source's own given the bands' tilts; `cells` hold q, the tilted base rate, instead."""
    table = _table(tilts)
    tilted = F.transform("cells", lambda c: F.struct(c["band"].alias("band"), c["t"].alias("t"), (c["base"] * F.exp(F.element_at(table, c["band"]))).alias("q")))

    def step(m: Column, _: Column) -> Column:
        def rate(c: Column) -> Column:
            return c["q"] * F.exp(m)

        sums = F.aggregate(
            "cells",
            F.struct(F.lit(0.0).alias("got"), F.lit(0.0).alias("slope")),
            lambda a, c: F.struct(
                (a["got"] + c["t"] * F.least(F.lit(MOST), rate(c))).alias("got"),
                (a["slope"] + F.when(rate(c) < MOST, c["t"] * rate(c)).otherwise(0.0)).alias("slope"),
            ),
            # a step of one at most keeps the iteration from overshooting where caps begin
            lambda a: F.when(a["slope"] > 0, (F.col("target") - a["got"]) / a["slope"]).otherwise(F.when(a["got"] > F.col("target"), -1.0).otherwise(0.0)),
        )
        return m + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sums))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0), step)
    return rows.withColumn("cells", tilted).withColumn("multiplier", F.when(F.col("cells").isNotNull() & (F.col("target") > 0), solved))


def _sums(solved: DataFrame) -> tuple[dict[int, float], dict[tuple[int, int], float]]:
    """(words taken by band, Schur complement of the Hessian by pair of bands), summed over all sources."""
    rate = lambda c: F.least(F.lit(MOST), c["q"] * F.exp("multiplier"))
    words = lambda k, f: F.aggregate(F.filter("cells", lambda c: c["band"] == k), F.lit(0.0), lambda a, c: a + f(c))
    bands = F.transform(
        F.array_distinct(F.transform("cells", lambda c: c["band"])),
        lambda k: F.struct(
            k.alias("k"),
            words(k, lambda c: c["t"] * rate(c)).alias("got"),
            words(k, lambda c: F.when(rate(c) < MOST, c["t"] * rate(c)).otherwise(0.0)).alias("curve"),
        ),
    )
    rows = solved.where("multiplier is not null").select(bands.alias("x"))
    rows = rows.withColumn("h", F.aggregate("x", F.lit(0.0), lambda a, b: a + b["curve"]))

    def pair(a: Column, b: Column) -> Column:
        same = a["k"] == b["k"]
        shared = F.when(F.col("h") > 0, a["curve"] * b["curve"] / F.col("h")).otherwise(0.0)
        return F.struct(a["k"].alias("k"), b["k"].alias("l"), F.when(same, a["got"]).otherwise(0.0).alias("got"), (F.when(same, a["curve"]).otherwise(0.0) - shared).alias("curve"))

    pairs = rows.select(F.explode(F.flatten(F.transform("x", lambda a: F.transform("x", lambda b: pair(a, b))))).alias("p"))
    found = pairs.groupBy("p.k", "p.l").agg(F.sum("p.got").alias("got"), F.sum("p.curve").alias("curve")).collect()  # 32 * 32 rows at most
    return {r["k"]: r["got"] for r in found if r["k"] == r["l"]}, {(r["k"], r["l"]): r["curve"] for r in found}


def linear(square: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small positive definite system, by elimination."""
    n = len(right)
    rows = [[*line, r] for line, r in zip(square, right, strict=True)]
    for i in range(n):
        best = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for k in range(i + 1, n):
            times = rows[k][i] / rows[i][i]
            rows[k] = [x - times * y for x, y in zip(rows[k], rows[i], strict=True)]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][k] * out[k] for k in range(i + 1, n))) / rows[i][i]
    return out


def _rated(rows: DataFrame) -> DataFrame:
    """Adds rate, whole (copies), part (the fraction left) and draw (the order of the draw)."""
    tilt = F.coalesce(F.element_at("tilts", F.col("band")), F.lit(0.0))
    rate = F.least(F.lit(MOST), F.col("base") * F.exp(F.col("multiplier") + tilt))
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    return (
        rows.withColumn("rate", F.when(F.col("size") > 0, F.coalesce(rate, F.lit(0.0))).otherwise(0.0))
        .withColumn("whole", F.floor("rate").cast("long"))
        .withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("draw", F.when(F.col("part") > 0, unit_hash(F.lit(SEED), "doc_id", "size") / F.col("part")))
    )


def plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Rows for each source: source_size, target, multiplier, and the edge of the draw (edge, at_edge words, ties).

    `sizes` is read several times, so hand in a checkpoint or a table. The edge is found without ordering a source:
    a histogram of the draws over about sqrt(documents) bins gives the bin in which the budget runs out, and only
    that bin is summed in order.
    """
    solved = cut(multipliers(sizes, targets(sizes, weights)))
    rated = _rated(attach(sizes.where("size > 0"), solved.select("source", "multiplier", "tilts", "documents", "target"), ["source"]))
    bins = F.ceil(F.sqrt(F.col("documents").cast("double")))
    drawn = rated.withColumn("bin", F.floor(bins * F.col("draw") / (F.col("draw") + 1)).cast("long"))
    histogram = cut(
        drawn.groupBy("source", "bin").agg(
            F.sum(F.col("size") * F.col("whole")).alias("taken"),
            F.sum(F.when(F.col("draw").isNotNull(), F.col("size")).otherwise(0)).alias("words"),
            F.max("target").alias("target"),
        )
    )
    per_source = Window.partitionBy("source")
    running = per_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        histogram.withColumn("budget", F.round("target").cast("long") - F.sum("taken").over(per_source))
        .withColumn("after", F.sum("words").over(running))
        .where((F.col("after") >= F.col("budget")) & (F.col("after") - F.col("words") < F.col("budget")))
        .where("bin is not null and budget > 0")
        .select("source", "bin", (F.col("budget") - F.col("after") + F.col("words")).alias("budget"))
    )
    found = cut(found)
    within = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    hit = attach(drawn, found.select("source", F.col("bin").alias("_bin"), F.col("budget")), ["source"]).where(
        "bin = _bin"
    )
    edges = (
        hit.groupBy("source", "draw", "budget")
        .agg(F.sum("size").alias("words"), F.count("*").alias("ties"))
        .withColumn("after", F.sum("words").over(within))
        .where("after >= budget and after - words < budget")
        .select(
            F.col("source").alias("_e"),
            F.col("draw").alias("edge"),
            (F.col("budget") - F.col("after") + F.col("words")).alias("at_edge"),
            "ties",
        )
    )
    spent = histogram.groupBy("source").agg(
        (F.round(F.max("target")).cast("long") - F.sum("taken")).alias("budget")
    ).withColumnRenamed("source", "_b")
    return cut(
        solved.join(edges, solved["source"].eqNullSafe(edges["_e"]), "left")
        .join(spent, solved["source"].eqNullSafe(spent["_b"]), "left")
        .select("source", "source_size", "target", "multiplier", "tilts", "edge", "at_edge", "ties", "budget")
    )


def mixed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """`rows` (with source, size, base) and the decisions: target, rate, copies (whole ones) and extra (words of a last,
    partial copy). Each decision follows from the row and its source's plan alone."""
    joined = _rated(attach(rows, sources, ["source"]))
    # without an edge, a budget left over is larger than all fractions together: they are all taken
    beyond = F.col("edge").isNull() & (F.coalesce(F.col("budget"), F.lit(0)) > 0)
    drawn = F.col("draw").isNotNull() & (beyond | (F.col("draw") < F.col("edge")))
    at = F.col("draw").isNotNull() & (F.col("draw") == F.col("edge"))
    share = F.floor(F.col("at_edge") / F.col("ties")).cast("long")
    return (
        joined.withColumn("extra", F.when(at, F.least(share, F.col("size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("copies", F.col("whole") + drawn.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("extra"))
        .drop("multiplier", "tilts", "edge", "at_edge", "ties", "budget", "whole", "part", "draw", "_bin")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The mixed corpus: each row of `docs` as often as it is taken, whole copies only.

    A partial copy at the edge of a draw is kept whole if at least half of it was due.
    """
    sizes = cut(sized(docs))
    sources = plan(sizes, weights)
    # a row travels as one column, so that none of its names can clash
    rows = docs.select(
        "doc_id", "source", count_words(F.col("text")).alias("size"), F.lit(1.0).alias("base"), F.struct(*docs.columns).alias("_row")
    ).withColumn("band", band_of(F.col("size")))
    decided = mixed(rows, sources)
    times = (F.col("copies") + (F.col("extra") * 2 >= F.col("size")).cast("long")).cast("int")
    return decided.where("size > 0").select("_row", F.explode(F.array_repeat(F.lit(0), times))).select("_row.*")
