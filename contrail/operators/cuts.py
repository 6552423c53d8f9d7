"""Cutting lineage and numbering rows in an order, through the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one in local mode, and an error on a cluster without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="contrail-")


def cut(df: DataFrame) -> DataFrame:
    """`df` from a reliable checkpoint in the shared folder, so that lost executors cost no lineage.

    Spark removes checkpoints that nothing refers to if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def row_numbers(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with `name`, 0..N-1 in their order.

    Ranges are sorted apart and offset by the sizes of the ranges before, so no task orders all rows. What meets in one
    task is one row for each range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # at most one row for each range, so the broadcast is bounded
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, number).drop("_part", "_offset", "_at")
