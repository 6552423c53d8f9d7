"""Order-dependent computations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cuts import cut, row_numbers
from .joins import small


def sessions(rows: DataFrame, by: list[str], time: str, tie: str, minutes: int = 60) -> DataFrame:
    """`rows` with `session`, 1 for the first of each group; a gap longer than `minutes` begins another."""
    order = Window.partitionBy(*by).orderBy(time, tie)
    gap = F.col(time).cast("timestamp").cast("double") - F.lag(F.col(time).cast("timestamp").cast("double")).over(order)
    new = F.when(gap.isNull() | (gap > minutes * 60), 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("session", F.sum("_new").over(order)).drop("_new")


def pair_checks(rows: DataFrame, by: str, time: str, tie: str, altitude: str, speed: str) -> DataFrame:
    """Physics checks of consecutive pairs by identity: backward time, climb over 1500 feet a minute, and speeds outside
    0..180 mph, which both members of a pair are checked for."""
    order = Window.partitionBy(by).orderBy(F.col(time).isNull(), time, tie)
    before = lambda c: F.lag(c).over(order)
    minutes = (F.col(time).cast("timestamp").cast("double") - before(F.col(time).cast("timestamp").cast("double"))) / 60
    pair = F.row_number().over(order) > 1
    odd = lambda c: F.coalesce(~c.between(0, 180), F.lit(False)).cast("int")
    checked = rows.select(
        by,
        pair.alias("pair"),
        F.coalesce(minutes < 0, F.lit(False)).cast("int").alias("backward"),
        F.coalesce((minutes > 0) & (F.abs(F.col(altitude) - before(F.col(altitude))) / minutes > 1500), F.lit(False)).cast("int").alias("climb"),
        (odd(F.col(speed)) + odd(before(F.col(speed)))).alias("speed"),
    )
    once = lambda c: F.sum(F.when(F.col("pair"), F.col(c)).otherwise(0))
    return checked.groupBy(by).agg(
        F.count("*").alias("observations"), once("backward").alias("backward"), once("climb").alias("climb"), once("speed").alias("speed")
    )


def monthly_changes(counts: DataFrame, entity: str, month: str, n: str) -> DataFrame:
    """Flags of a dense grid entity x month: z-score on the entity's history, change to the month before.

    The grid is every entity in every month, by definition; months are counted before they are broadcast.
    """
    months = small(counts.select(month).distinct())
    grid = counts.select(entity).distinct().crossJoin(months).join(counts, [entity, month], "left").na.fill(0, [n])
    order = Window.partitionBy(entity).orderBy(month)
    all_ = Window.partitionBy(entity)
    spread = F.stddev_pop(n).over(all_)
    prior = F.lag(n).over(order)
    seen = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1))
    z = (F.col(n) - F.avg(n).over(all_)) / F.when(spread == 0, 1.0).otherwise(spread)
    flag = (
        F.when((F.col(n) == 0) & (F.col("prior") > 0), "vanished")
        .when((F.col(n) > 0) & (F.col("prior") == 0) & (F.col("seen") == 0), "debut")
        .when((F.col(n) > 0) & (F.col("prior") == 0), "returned")
        .when(F.col("z") >= 1.5, "surge")
        .when(F.col("z") <= -1.5, "decline")
        .otherwise("stable")
    )
    return grid.withColumns({"z": z, "prior": prior, "seen": seen}).withColumn("delta", F.col(n) - F.col("prior")).withColumn("flag", flag).drop("seen")


def running_max(rows: DataFrame, by: str, value: str, order: list[Column], name: str) -> DataFrame:
    """`rows` with `name`, the largest value so far in each group's order.

    Groups are cut into ranges of their order, each windowed by one task, so that none holds a whole group; what comes before a
    range adds one row for each range and group. Rows equal in order must be equal in value or bear another column in it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(by), *order]
    placed = cut(rows.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    most = placed.groupBy("_part", by).agg(F.max(value).alias("_most"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = small(cut(most.select(F.col("_part").alias("_p"), F.col(by).alias("_g"), F.max("_most").over(before).alias("_ahead"))))
    own = F.max(value).over(Window.partitionBy("_part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    met = placed.withColumn("_own", own).join(ahead, (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_g")))
    return met.withColumn(name, F.greatest("_own", "_ahead")).select(*rows.columns, name)


def batch_plan(rows: DataFrame, order: list[Column], size: int) -> DataFrame:
    """`rows` with batch_index and position in their order."""
    placed = row_numbers(rows, order, "_i")
    return placed.withColumn("batch_index", F.floor(F.col("_i") / size)).withColumn("position", F.col("_i") % size).drop("_i")
