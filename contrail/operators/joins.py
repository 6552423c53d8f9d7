"""Joins that Spark has no operator for, as bucketed equi-joins with the exact condition after them."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import RADIUS, haversine, inside
from .cuts import cut

#: A dimension of at most this many rows may be broadcast.
SMALL = 50_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """`df` marked for broadcast if it has at most `most` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def band_join(left: DataFrame, right: DataFrame, by: list[str], l_time: str, r_time: str, seconds: int, keep: str | None = None, how: str = "inner") -> DataFrame:
    """Pairs with equal `by` whose times (columns of the two sides) are at most `seconds` apart; with `how` left, rows of the
    left that meet nothing too.

    Times fall into buckets twice as wide as the band; the right side is copied to the two that it may reach, so that each pair
    meets in exactly one. Work is in proportion to the rows of two buckets, never to the product of the sides. `keep` names a
    column for the bucket of the left row, by which and `by` the pairs are dealt already.
    """
    one, two = _time_buckets(left, right, l_time, r_time, seconds)
    names = [*by, "_bucket"]
    two = two.withColumnsRenamed({c: f"_r{c}" for c in names})
    apart = F.abs(_micros(F.col(l_time)) - _micros(F.col(r_time)))
    on = [F.col(c) == F.col(f"_r{c}") for c in names]
    met = one.join(two, _all([*on, apart <= seconds * 1_000_000]), how).drop(*[f"_r{c}" for c in names])
    return met.withColumnRenamed("_bucket", keep) if keep else met.drop("_bucket")


def span_join(left: DataFrame, right: DataFrame, time: str, low: str, high: str, micros: int, how: str = "inner") -> DataFrame:
    """Pairs of a row of the left and one of the right whose span of microseconds, `low` to `high`, holds the former's `time`; with `how`
    left, rows of the left without one too. Spans are copied to the buckets of `micros` that they touch, two if they are no longer."""
    bucket = lambda c: F.floor(F.col(c) / F.lit(micros)).cast("long")
    two = right.withColumn("_rbucket", F.explode(F.sequence(bucket(low), bucket(high))))
    one = left.withColumn("_bucket", bucket(time))
    return one.join(two.hint("merge"), (F.col("_bucket") == F.col("_rbucket")) & F.col(time).between(F.col(low), F.col(high)), how).drop("_bucket", "_rbucket")


def nearest_spans(rows: DataFrame, key: str, time: str, most: int) -> DataFrame:
    """`rows` with `low` and `high`: the whole numbers within `most` of their `time` that no other row of equal `key` is nearer to, so that any
    number lies in one span of a key at most. Of two as near the earlier has it; rows that are nearest to none go."""
    along = Window.partitionBy(key).orderBy(time)
    middle = lambda a, b: F.call_function("shiftright", a + b, F.lit(1))
    t, before, after = F.col(time), F.lag(time).over(along), F.lead(time).over(along)
    return rows.withColumns({"low": F.greatest(t - most, middle(before, t) + 1), "high": F.least(t + most, middle(t, after))}).where("low <= high")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _time_buckets(left: DataFrame, right: DataFrame, l_time: str, r_time: str, seconds: int, bands: int = 2) -> tuple[DataFrame, DataFrame]:
    """Both sides with `_bucket`, `bands` (two or more) wide, the right one copied to those that the band reaches, two at most."""
    most = seconds * 1_000_000
    bucket = lambda us: F.floor(us / F.lit(bands * most + 1)).cast("long")
    near = F.sequence(bucket(_micros(F.col(r_time)) - most), bucket(_micros(F.col(r_time)) + most))
    return left.withColumn("_bucket", bucket(_micros(F.col(l_time)))), right.withColumn("_bucket", F.explode(near))


def radius_join(points: DataFrame, places: DataFrame, most_km: float, p: tuple[str, str], q: tuple[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs within `most_km`, with `distance_km`, on cells of latitude and longitude; p and q name (lat, lon), `by` further
    columns that must be equal.

    A cell is twice as high as the radius and a whole part of the circle wide; places are copied to the cells that the radius
    reaches, four of them far from the poles, across the date line too. Rows without coordinates meet nothing.
    """
    one, two = _cells(points, places, most_km, p, q)
    distance = haversine(F.col(p[0]), F.col(p[1]), F.col(q[0]), F.col(q[1]))
    met = one.join(two, [*by, "_y", "_x"])
    return met.drop("_y", "_x").withColumn("distance_km", distance).where(F.col("distance_km") <= most_km)


def _cells(points: DataFrame, places: DataFrame, most_km: float, p: tuple[str, str], q: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Both with the cell (_y, _x), places copied to those that the radius reaches."""
    reach = max(most_km / 110.0, 1e-4)
    across = max(1, math.floor(360.0 / (2 * reach)))
    size = 360.0 / across
    row = lambda c: F.floor(c / size).cast("long")
    column = lambda c: F.floor(c / size).cast("long")
    east = lambda c: F.pmod(c + 180.0, F.lit(360.0))
    # longitudes shrink with latitude: reach as far as the pole-ward edge of the place's neighbourhood needs, all round near a pole
    edge = F.abs(F.col(q[0])) + reach
    wide = F.lit(reach) / F.cos(F.radians(F.least(F.lit(89.0), edge)))
    low, high = column(east(F.col(q[1])) - wide), column(east(F.col(q[1])) + wide)
    around = F.when((edge >= 89.0) | (high - low + 1 >= across), F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))).otherwise(
        F.transform(F.sequence(low, high), lambda x: F.pmod(x, F.lit(across).cast("long")))
    )
    known = F.col(q[0]).isNotNull() & F.col(q[1]).isNotNull()
    two = places.where(known).withColumn("_y", F.explode(F.sequence(row(F.col(q[0]) - reach), row(F.col(q[0]) + reach)))).withColumn("_x", F.explode(around))
    one = points.withColumn("_y", row(F.col(p[0]))).withColumn("_x", F.pmod(column(east(F.col(p[1]))), F.lit(across).cast("long")))
    return one, two


#: Pairs that a task of `band_radius_join` looks at together, and bands of time in one of its groups.
LOOKED_AT, BANDS = 200_000, 16


def band_radius_join(left: DataFrame, right: DataFrame, l_time: str, r_time: str, seconds: int, most_km: float, p: tuple[str, str], q: tuple[str, str], alike: tuple[str, str]) -> DataFrame:
    """Pairs at most `seconds` and `most_km` apart: the columns of both sides but times, positions and the two of `alike`; `apart_us`,
    `distance_km`, and `alike`, whether these two are equal.

    Rows meet by time bucket and cell. A group holds its rows of both sides, not their pairs: in order of time a row's candidates are
    a stretch of the other side, of which those as near as the radius are picked by products of directions, many at once. Only
    what may be a pair is measured and written.
    """
    ends = ((left, l_time, p, alike[0]), (right, r_time, q, alike[1]))
    kept = [[c for c in df.columns if c not in (time, *at, same)] for df, time, at, same in ends]
    sides = _cells(*_time_buckets(left, right, l_time, r_time, seconds, BANDS), most_km, p, q)
    both = None
    for side, (df, (_, time, at, same)) in enumerate(zip(sides, ends, strict=True)):
        known = df.where(F.col(time).isNotNull() & F.col(at[0]).isNotNull() & F.col(at[1]).isNotNull())
        numbers = [_micros(F.col(time)).alias("_at"), F.col(at[0]).cast("double").alias("_lat"), F.col(at[1]).cast("double").alias("_lon")]
        one = known.select("_bucket", "_y", "_x", F.lit(side).alias("_side"), *numbers, F.col(same).alias("_same"), *kept[side])
        both = one if both is None else both.unionByName(one, allowMissingColumns=True)
    types = [f"`{c}` {df.schema[c].dataType.simpleString()}" for (df, *_), names in zip(ends, kept, strict=True) for c in names]
    most, across = seconds * 1_000_000, 2 * RADIUS["km"]
    least = math.cos(min(2 * most_km / across, math.pi)) - 1e-12

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("_at").combine_chunks()
        kinds = pc.unique(table.column("_same").drop_null())
        table = table.append_column("_kind", pc.index_in(table.column("_same"), value_set=kinds, skip_nulls=True))
        halves = [table.filter(pc.equal(table.column("_side"), side)).combine_chunks() for side in (0, 1)]
        if not all(len(h) for h in halves):
            return
        at, at2 = (h.column("_at").to_numpy() for h in halves)
        kind, kind2 = (pc.fill_null(h.column("_kind"), none).to_numpy() for h, none in zip(halves, (-1, -2), strict=True))
        ways = []
        for half in halves:
            lat, lon = (np.radians(half.column(c).to_numpy()) for c in ("_lat", "_lon"))
            ways.append(np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)]))
        low, high = np.searchsorted(at2, at - most), np.searchsorted(at2, at + most, "right")
        columns = [(half.column(c).chunk(0), side) for side, (half, names) in enumerate(zip(halves, kept, strict=True)) for c in names]
        a = 0
        while a < len(at):
            # as many rows as look at no more than LOOKED_AT others, one at least
            start = low[a]
            ahead = high[a + 1 : a + LOOKED_AT // max(1, int(high[a] - start))] - start
            b = a + 1 + int(np.searchsorted(ahead * np.arange(2, len(ahead) + 2), LOOKED_AT, "right"))
            close = ways[0][:, a:b].T @ ways[1][:, start : high[b - 1]] >= least
            i = np.repeat(np.arange(a, b), np.count_nonzero(close, axis=1))
            j = np.flatnonzero(close) - (i - a) * close.shape[1] + start
            apart = np.abs(at[i] - at2[j])
            km = across * np.arcsin(np.minimum(1.0, np.sqrt(sum((w[i] - v[j]) ** 2 for w, v in zip(*ways, strict=True))) / 2))
            near = np.flatnonzero((apart <= most) & (km <= most_km))
            if len(near):
                i, j = i[near], j[near]
                rows = [pa.array(i), pa.array(j)]
                made = [pa.array(apart[near]), pa.array(km[near]), pa.array(kind[i] == kind2[j])]
                yield pa.RecordBatch.from_arrays([*(c.take(rows[side]) for c, side in columns), *made], names=[*kept[0], *kept[1], "apart_us", "distance_km", "alike"])
            a = b

    keys = ["_bucket", "_y", "_x"]
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(parts, *keys).groupBy(*keys).applyInArrow(meet, ", ".join([*types, "apart_us long", "distance_km double", "alike boolean"]))


def box_join(points: DataFrame, boxes: DataFrame, p: tuple[str, str], box: tuple[str, str, str, str], size: float) -> DataFrame:
    """Pairs of a point (lat, lon) and a box (south, west, north, east) that holds it, edges included; they meet by cells
    of `size` degrees, of which a box is copied to those that it touches."""
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    south, west, north, east = box
    two = boxes.withColumn("_y", F.explode(F.sequence(cell(south), cell(north)))).withColumn("_x", F.explode(F.sequence(cell(west), cell(east))))
    one = points.withColumn("_y", cell(p[0])).withColumn("_x", cell(p[1]))
    inside = F.col(p[0]).between(F.col(south), F.col(north)) & F.col(p[1]).between(F.col(west), F.col(east))
    # few boxes are sent to the points, so that no task gets all points of a crowded cell
    return one.join(small(two), ["_y", "_x"]).where(inside).drop("_y", "_x")


def polygon_join(points: DataFrame, polygons: DataFrame, p: tuple[str, str], size: float) -> DataFrame:
    """Pairs of a point (lat, lon) and a polygon (`rings`, and its envelope south, west, north, east) that holds it, edges
    included; they meet by cells of `size` degrees."""
    met = box_join(points, polygons, p, ("south", "west", "north", "east"), size)
    return met.where(inside(F.col(p[1]), F.col(p[0]), F.col("rings")))


#: Up to so many places are broadcast and all compared; the result is the same either way.
FEW = 500
#: Radii in kilometres within which the nearest place is looked for, the last one half way round the earth.
RINGS = (10.0, 50.0, 250.0, 1250.0, 6250.0, 20_040.0)


def nearest(points: DataFrame, places: DataFrame, id_: str, p: tuple[str, str], q: tuple[str, str], order: list[Column], most_km: float = RINGS[-1]) -> DataFrame:
    """Each row of `points` with its nearest place within `most_km`; `order` breaks ties.

    Rows are looked up within growing radii: what is found within one is nearest, and only the rest goes on to the next.
    Equal rows stay apart. Rows without coordinates, or without a place, are left out. `id_` names the points' id.
    """
    known = points.where(F.col(p[0]).isNotNull() & F.col(p[1]).isNotNull())
    # rows of one position share their place, so only positions are looked up
    spots = known.select(F.col(p[0]).alias("_lat"), F.col(p[1]).alias("_lon")).distinct()
    best = _nearest_spots(spots, places, q, [c.alias(f"_o{i}") for i, c in enumerate(order)], most_km)
    met = known.join(best, (F.col(p[0]) == F.col("_lat")) & (F.col(p[1]) == F.col("_lon")))
    return met.select(*points.columns, *[F.col(f"_b._q.{c}").alias(c) for c in places.columns], "_b.distance_km")


def _nearest_spots(spots: DataFrame, places: DataFrame, q: tuple[str, str], ties: list[Column], most_km: float) -> DataFrame:
    """Rows (_lat, _lon, _b) of positions that have a place within `most_km`: its distance, what breaks ties, and its columns."""
    placed = places.where(F.col(q[0]).isNotNull() & F.col(q[1]).isNotNull())
    row = F.struct(*[F.col(c) for c in places.columns]).alias("_q")
    if places.limit(FEW + 1).count() <= FEW:
        # so few places are all compared, within the row of each position: no pair is a row, and nothing is dealt or sorted
        every = placed.agg(F.collect_list(F.struct(*ties, row)).alias("_all"))
        far = lambda x: haversine(F.col("_lat"), F.col("_lon"), x["_q"][q[0]], x["_q"][q[1]])
        each = F.transform("_all", lambda x: F.struct(far(x).alias("distance_km"), *[x[f"_o{i}"].alias(f"_o{i}") for i in range(len(ties))], x["_q"].alias("_q")))
        met = spots.crossJoin(F.broadcast(every)).withColumn("_b", F.array_min(F.filter(each, lambda x: x["distance_km"] <= most_km)))
        return met.where("_b is not null").select("_lat", "_lon", "_b")
    rest, found = cut(spots), None
    for km in [*[r for r in RINGS if r < most_km], most_km]:
        met = radius_join(rest, placed, km, ("_lat", "_lon"), q)
        hit = cut(met.groupBy("_lat", "_lon").agg(F.min(F.struct("distance_km", *ties, row)).alias("_b")))
        found = hit if found is None else found.unionByName(hit)
        rest = cut(rest.join(hit.select("_lat", "_lon"), ["_lat", "_lon"], "left_anti"))
        if rest.isEmpty():
            break
    return found


def last_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the last in order."""
    turned = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(turned)).where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """`old` with rows of `new` added, or put in place of those with the same key."""
    return old.join(new, key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_missing(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """`old` with those rows of `new` whose key it lacks, one for each key."""
    return old.unionByName(new.dropDuplicates(key).join(old, key, "left_anti"), allowMissingColumns=True)


def hamming_pairs(rows: DataFrame, id_: str, bits: str, most: int = 4) -> DataFrame:
    """Pairs (a, b, distance) of different 64-bit hashes that differ in at most `most` bits, each by its least id.

    The bits are cut into most + 2 pieces of nearly equal width; two hashes within the distance agree on two pieces at
    least, so two pieces together are the join key: 15 keys of 21 bits for a distance of four.
    """
    pieces = most + 2
    ends = [64 * i // pieces for i in range(pieces + 1)]
    kinds = rows.groupBy(bits).agg(F.min(id_).alias("_id"))
    part = [F.shiftrightunsigned(F.shiftleft(F.col(bits), 64 - e), 64 - (e - s)) for s, e in zip(ends, ends[1:], strict=False)]
    keys = [F.xxhash64(F.lit(i), F.lit(j), part[i], part[j]) for i, j in itertools.combinations(range(pieces), 2)]
    exploded = kinds.select("_id", bits, F.explode(F.array(*keys)).alias("_p"))
    a = exploded.select(F.col("_id").alias("a"), F.col(bits).alias("_x"), "_p")
    b = exploded.select(F.col("_id").alias("b"), F.col(bits).alias("_y"), "_p")
    distance = F.bit_count(F.col("_x").bitwiseXOR(F.col("_y")))
    return a.join(b, "_p").where("a < b").withColumn("distance", distance).where(F.col("distance") <= most).select("a", "b", "distance").distinct()
