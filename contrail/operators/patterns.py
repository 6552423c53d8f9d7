"""Many names looked for in texts at once, at any place, by an Aho-Corasick automaton in each task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cuts import cut, row_numbers
from .joins import small

#: Characters of the names of one automaton; more names make more automata, each sent to the tasks apart.
BLOCK_CHARS = 2_000_000
#: Rows of a batch, so that long texts stay small.
ROWS = 1000


def _hits(automaton) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pickle.loads(automaton.value)
        for batch in batches:
            found = [sorted({n for _, n in names.iter(t)}) if t else [] for t in batch.column("_text").to_pylist()]
            at = [i for i, x in enumerate(found) if x]
            yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(at, pa.int64())), pa.array([found[i] for i in at], pa.list_(pa.int64()))], names=["_row", "_hits"])

    return look


def contained(texts: DataFrame, text: str, names: DataFrame, name: str) -> DataFrame:
    """Rows of `texts` and `names`, once each, whose `text` holds the string `name`, at any place.

    Names are cut into blocks of about BLOCK_CHARS characters, which bounds what is sent to the tasks; a text is read once a
    block, in time that grows with its length and its hits, not with the names. Null and empty names are in no text.
    """
    spark = texts.sparkSession
    keys = cut(row_numbers(names.select(F.col(name).alias("_name")).where(F.length(name) > 0).distinct(), [F.col("_name")], "_number"))
    chars = keys.agg(F.sum(F.length("_name"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(conf, str(min(ROWS, int(spark.conf.get(conf, "10000")))))
    rows = texts.select(F.col(text).alias("_text"), F.struct(*texts.columns).alias("_row"))
    found = None
    for b in range(blocks):
        automaton = ahocorasick.Automaton()
        for row in keys.where(F.pmod("_number", F.lit(blocks)) == b).toLocalIterator():
            automaton.add_word(row["_name"], row["_number"])
        automaton.make_automaton()
        sent = spark.sparkContext.broadcast(pickle.dumps(automaton))
        kind = rows.schema["_row"].dataType.simpleString()
        part = rows.mapInArrow(_hits(sent), f"_row {kind}, _hits array<bigint>")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.join(names, F.lit(False))
    met = found.select("_row", F.explode("_hits").alias("_number")).join(small(keys), "_number")
    known = names.withColumn("_name", F.col(name))
    return met.join(small(known), "_name").select("_row.*", *[F.col(c) for c in names.columns])


def parts_of(names: DataFrame, name: str, out: str) -> DataFrame:
    """`names` with `out`, each string that `name` holds, once each; short names only, as a name of n characters has up to n(n+1)/2."""
    n = F.length(name)
    starts = F.sequence(F.lit(1), n)
    parts = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substr(F.col(name), i, k))))
    return names.where(n > 0).withColumn(out, F.explode(F.array_distinct(parts)))
