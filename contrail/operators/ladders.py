"""Zoom ladders: the scale that most independent evidence agrees on, and the whole powers of two around it."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cuts import cut
from .joins import small

#: How far, in powers of two, a scale may lie from its level, and how many pieces of evidence make a level fit to pass on.
TOLERANCE = 0.18
SUPPORT = 3


class RunningMedian:
    """The median of values that come, and that are taken back for others, by two heaps with late removal."""

    def __init__(self):
        self.low: list[float] = []  # negated, the largest first
        self.high: list[float] = []
        self.gone: tuple[dict, dict] = defaultdict(int), defaultdict(int)
        self.sizes = [0, 0]

    def __len__(self) -> int:
        return sum(self.sizes)

    def _clean(self) -> None:
        for heap, sign, gone in ((self.low, -1, self.gone[0]), (self.high, 1, self.gone[1])):
            while heap and gone.get(sign * heap[0]):
                gone[sign * heapq.heappop(heap)] -= 1

    def _even(self) -> None:
        self._clean()
        while self.sizes[0] > self.sizes[1] + 1:
            heapq.heappush(self.high, -heapq.heappop(self.low))
            self.sizes = [self.sizes[0] - 1, self.sizes[1] + 1]
            self._clean()
        while self.sizes[0] < self.sizes[1]:
            heapq.heappush(self.low, -heapq.heappop(self.high))
            self.sizes = [self.sizes[0] + 1, self.sizes[1] - 1]
            self._clean()

    def add(self, value: float) -> None:
        if self.low and value > -self.low[0]:
            heapq.heappush(self.high, value)
            self.sizes[1] += 1
        else:
            heapq.heappush(self.low, -value)
            self.sizes[0] += 1
        self._even()

    def remove(self, value: float) -> None:
        below = bool(self.low) and value <= -self.low[0]
        self.gone[0 if below else 1][value] += 1
        self.sizes[0 if below else 1] -= 1
        self._even()

    @property
    def value(self) -> float:
        self._clean()
        return -self.low[0] if self.sizes[0] > self.sizes[1] else (-self.low[0] + self.high[0]) / 2


class _Group:
    """The values of one piece of evidence in a cluster, which come in order; its median moves up along them."""

    def __init__(self):
        self.values: list[float] = []
        self.ends: list[int] = []  # how many there are up to each value
        self.at = 0

    def _nth(self, n: int) -> float:
        while self.ends[self.at] <= n:
            self.at += 1
        return self.values[self.at]

    def add(self, value: float, times: int) -> float:
        total = (self.ends[-1] if self.ends else 0) + times
        self.values.append(value)
        self.ends.append(total)
        low = self._nth((total - 1) // 2)
        return low if total % 2 else (low + (low if self.ends[self.at] > total // 2 else self.values[self.at + 1])) / 2


class _Cluster:
    def __init__(self):
        self.groups: dict[str, _Group] = {}
        self.medians: dict[str, float] = {}
        self.middle = RunningMedian()

    def add(self, value: float, group: str, times: int) -> None:
        new = self.groups.setdefault(group, _Group()).add(value, times)
        if group in self.medians:
            if new == self.medians[group]:
                return
            self.middle.remove(self.medians[group])
        self.medians[group] = new
        self.middle.add(new)


def _seeds(tolerance: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, clusters = None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([here[0]] * len(clusters), pa.string()), pa.array([c.middle.value for c in clusters]), pa.array([len(c.middle) for c in clusters])], names=["profile", "center", "support"])

        for batch in batches:
            for profile, run, z, group, n in zip(*(batch.column(c).to_pylist() for c in ("profile", "run", "z", "group", "n")), strict=True):
                if (profile, run) != here:
                    if clusters:
                        yield rows()
                    here, clusters = (profile, run), []
                near = next((c for c in clusters if abs(z - c.middle.value) <= tolerance), None)
                if near is None:
                    near = _Cluster()
                    clusters.append(near)
                near.add(z, group, n)
        if clusters:
            yield rows()

    return scan


def reference_scales(records: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows (profile, reference): the log2 scale in the middle of each profile's densest cluster.

    Scales, in order, join the first cluster whose middle, the median over pieces of evidence of their own medians, is
    within the tolerance, or begin one; the densest has most pieces of evidence, the least of equals. `records` has profile,
    evidence and z, the log2 of the scale. Equal scales always join the same cluster, so they are counted first; a stretch as
    wide as the tolerance without any scale parts clusters for good, so what lies between such gaps is scanned apart, each
    as one ordered stream that keeps only its clusters' state.
    """
    counted = cut(records.groupBy(F.col("profile").cast("string").alias("profile"), "z", F.col("evidence").cast("string").alias("group")).agg(F.count("*").alias("n")))
    bucket = F.floor(F.col("z") / tolerance)
    buckets = counted.select("profile", bucket.alias("b")).distinct()  # a few hundred in a profile
    line = Window.partitionBy("profile").orderBy("b")
    runs = buckets.withColumn("run", F.sum(F.coalesce((F.col("b") - F.lag("b").over(line) > 1).cast("int"), F.lit(1))).over(line))
    placed = counted.withColumn("b", bucket).join(runs, ["profile", "b"])
    ordered = placed.select("profile", "run", "z", "group", "n").repartition("profile", "run").sortWithinPartitions("profile", "run", "z", "group")
    found = ordered.mapInArrow(_seeds(tolerance), "profile string, center double, support long")
    return found.groupBy("profile").agg(F.min_by("center", F.struct(-F.col("support"), "center")).alias("reference"))


def stepped(records: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """`records` (profile, evidence, scale) with `z`, its log2, and `rung`: how many whole steps it lies from its profile's reference,
    null if it lies further from a step than the tolerance."""
    known = cut(records.withColumn("z", F.log2("scale")))
    met = known.withColumn("profile", F.col("profile").cast("string")).join(small(cut(reference_scales(known, tolerance))), "profile")
    rung = F.rint(F.col("z") - F.col("reference"))
    return met.withColumn("rung", F.when(F.abs(F.col("z") - (F.col("reference") + rung)) <= tolerance, rung.cast("long"))).drop("reference")


def rungs(placed: DataFrame, values: list[str], support: int = SUPPORT) -> DataFrame:
    """Rows (profile, rung, scale, `values`, support, dispersion, records, eligible) of `stepped` records: medians over pieces of evidence
    of their own medians."""
    medians = [F.median(c).alias(c) for c in ("z", *values)]
    own = cut(placed.where("rung IS NOT NULL").groupBy("profile", "rung", "evidence").agg(*medians, F.count("*").alias("records")))
    level = own.groupBy("profile", "rung").agg(*medians, F.count("*").alias("support"), F.sum("records").alias("records"))
    spread = own.join(level.select("profile", "rung", F.col("z").alias("_z")), ["profile", "rung"]).groupBy("profile", "rung").agg(F.median(F.abs(F.col("z") - F.col("_z"))).alias("dispersion"))
    met = level.join(spread, ["profile", "rung"])
    return met.select("profile", "rung", F.pow(F.lit(2.0), "z").alias("scale"), *values, "support", "dispersion", "records", (F.col("support") >= support).alias("eligible"))
