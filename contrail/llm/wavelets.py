"""Ranked lexical search by dual-sorted wavelet trees, one for each shard of documents.

A shard's postings stand term after term, each term's by falling impact; a wavelet tree over their document numbers (in the
matrix layout: each level puts the postings whose next bit is 0 before the others, stably) keeps that order in every node.
So a node, which is a range of document numbers, holds each term's postings in it as a range whose first posting has the
greatest impact, and the weighted sum of the first impacts bounds the score of all documents below. A search descends from the
root into the nodes of the greatest bounds, for all terms at a time, until no bound reaches the k-th best document found;
at a leaf the bound is the score. What it finds is exact, equal scores by ascending id.

Shards are what a task has read until it holds SHARD_WORDS words, so the index needs no shuffle; it covers every document and
all terms, and is written as a table. Document counts are summed over shards, weights follow from them, and queries go to
the shards in blocks. A task carries each query's k-th best score from shard to shard.

Terms are runs of letters, digits and characters beyond ASCII, with A-Z as a-z. Nulls: a null text has no terms, null ids rank
before others at equal scores; a text without terms is not counted and never found. Rows that repeat an id are documents of
their own. Queries equal in id and text are one. Very long texts are read whole; one longer than a shard makes a longer one.
Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.cuts import row_numbers, shared_folder
from .shared import cut, lean
from .words import Words, classes, words

#: Bytes of terms: letters, digits and all beyond ASCII.
TERM = classes(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Words of a shard, which bound a task's memory.
SHARD_WORDS = 1_000_000
#: Queries of a block.
BLOCK = 256
#: Nodes that a search opens at a time.
OPENED = 256
#: A null id, which comes before all others.
_NONE = np.iinfo(np.int64).min
#: Bits that hold an impact, which is below a million.
_IMPACT = 20
_INDEX = "ids binary, terms binary, ends binary, starts binary, impacts binary, bits binary, height int"


# -- the index -------------------------------------------------------------------------------------


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.bincount(words(batch.column("text"), TERM).row, minlength=len(batch))
        yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["docs", "terms"])


def totals(docs: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms they have."""
    found = lean(docs.select("text")).mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return found["docs"] or 0, found["terms"] or 0


def impacts(tf: np.ndarray, sizes: np.ndarray, n: int, total: int) -> np.ndarray:
    """What an occurrence of weight 1 adds to the score of a document that has `tf` of a term among its `sizes` terms."""
    m = 100 - 25 + (25 * sizes * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def layered(numbers: np.ndarray, height: int) -> np.ndarray:
    """The bits of a wavelet matrix over `numbers`, one row for each of `height` levels, packed."""
    levels = []
    for level in range(height):
        bits = (numbers >> (height - 1 - level)) & 1
        levels.append(np.packbits(bits.astype(np.uint8)))
        numbers = np.concatenate([numbers[bits == 0], numbers[bits == 1]])
    return np.array(levels, np.uint8)


def _indexed(ids: np.ndarray, found: Words, n: int, total: int) -> dict[str, bytes | int]:
    """One shard's row of the index."""
    sizes = np.bincount(found.row, minlength=len(ids))
    order = np.argsort(ids, kind="stable")
    order = order[sizes[order] > 0]
    number = np.full(len(ids), -1)
    number[order] = np.arange(len(order))
    coded = found.array().dictionary_encode()
    pairs, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(order) + number[found.row], return_counts=True)
    term, doc = pairs // len(order), pairs % len(order)
    weight = impacts(tf, sizes[order][doc], n, total)
    by_impact = np.argsort((term << _IMPACT) - weight, kind="stable")
    height = max(1, int(len(order) - 1).bit_length())
    names = coded.dictionary
    ends = np.frombuffer(names.buffers()[1], np.int64)[: len(names) + 1]
    return {
        "ids": ids[order].tobytes(),
        "terms": names.buffers()[2].to_pybytes()[: ends[-1]],
        "ends": ends.tobytes(),
        "starts": np.searchsorted(term, np.arange(len(names) + 1)).tobytes(),
        "impacts": weight[by_impact].astype(np.int32).tobytes(),
        "bits": layered(doc[by_impact], height).tobytes(),
        "height": height,
    }


def _shards(n: int, total: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        held: list[Words] = []

        def row() -> pa.RecordBatch:
            before = np.cumsum([0] + [len(x) for x in ids])
            whole = Words(*(np.concatenate([w[i] + (b if i == 2 else 0) for w, b in zip(held, before[:-1], strict=True)]) if i < 3 else held[0].first for i in range(4)))
            made = _indexed(np.concatenate(ids), whole, n, total)
            arrays = [pa.array([v], pa.int32() if k == "height" else pa.binary()) for k, v in made.items()]
            return pa.RecordBatch.from_arrays(arrays, names=list(made))

        for batch in batches:
            found = words(batch.column("text"), TERM)
            if len(found.lengths):
                ids.append(batch.column("doc_id").cast(pa.int64()).fill_null(_NONE).to_numpy())
                held.append(found)
            if sum(len(w.lengths) for w in held) >= SHARD_WORDS:
                yield row()
                ids, held = [], []
        if held:
            yield row()

    return shards


def index(docs: DataFrame) -> tuple[DataFrame, int]:
    """(index, documents with a term): one row for each shard, to be written once and read by every search."""
    n, total = totals(docs)
    return lean(docs.select("doc_id", "text")).mapInArrow(_shards(n, total), _INDEX), n


# -- the search ------------------------------------------------------------------------------------


class Tree:
    """A shard's wavelet tree, read for searching: of every level the postings with bit 0 before each place, and the impacts in its
    order."""

    def __init__(self, bits: bytes, impacts: bytes, height: int):
        first = np.frombuffer(impacts, np.int32)
        n = len(first)
        packed = np.frombuffer(bits, np.uint8).reshape(height, -1)
        self.height, self.size = height, n
        self.before = np.zeros((height, n + 1), np.int32)
        self.impacts = np.zeros((height + 1, n + 1), np.int32)  # the last place is for ranges at the end
        self.impacts[0, :n] = first
        for level in range(height):
            zero = np.unpackbits(packed[level], count=n) == 0
            np.cumsum(zero, out=self.before[level, 1:], dtype=np.int32)
            own = self.impacts[level, :n]
            zeros = self.before[level, n]
            self.impacts[level + 1, :zeros] = own[zero]
            self.impacts[level + 1, zeros:n] = own[~zero]
        self.zeros = self.before[:, n]

    def bounds(self, level: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The weighted sum of each node's first impacts."""
        return (np.where(start < end, self.impacts[level[:, None], start], 0).astype(np.int64) * weight).sum(axis=1)

    def best(self, start: np.ndarray, end: np.ndarray, weight: np.ndarray, ids: np.ndarray, k: int, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, id) among `known` and the documents of the tree, best first, for terms with the given ranges of
        postings and weights."""
        scores, found = known
        level, number = np.zeros(1, np.int64), np.zeros(1, np.int64)
        start, end = start[None, :].astype(np.int64), end[None, :].astype(np.int64)
        bound = self.bounds(level, start, end, weight)
        while True:
            hopeful = bound > 0
            if len(scores) == k:
                # a node's least id; nodes past the last document are empty
                low = ids[np.minimum(number << (self.height - level), len(ids) - 1)]
                hopeful &= (bound > scores[-1]) | ((bound == scores[-1]) & (low < found[-1]))
            if not hopeful.all():
                level, number, start, end, bound = level[hopeful], number[hopeful], start[hopeful], end[hopeful], bound[hopeful]
            if not len(bound):
                return scores, found
            some = np.argpartition(-bound, OPENED - 1)[:OPENED] if len(bound) > OPENED else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[some] = False
            at, n, s, e = level[some], number[some], start[some], end[some]
            zs, ze = self.before[at[:, None], s], self.before[at[:, None], e]
            zeros = self.zeros[at][:, None]
            at = np.concatenate([at, at]) + 1
            n = np.concatenate([2 * n, 2 * n + 1])
            s, e = np.concatenate([zs, zeros + s - zs]).astype(np.int64), np.concatenate([ze, zeros + e - ze]).astype(np.int64)
            b = self.bounds(at, s, e, weight)
            leaf = at == self.height
            hit = leaf & (b > 0)
            if hit.any():
                scores, found = _top(np.concatenate([scores, b[hit]]), np.concatenate([found, ids[n[hit]]]), k)
            inner = ~leaf
            level, number = np.concatenate([level[rest], at[inner]]), np.concatenate([number[rest], n[inner]])
            start, end = np.concatenate([start[rest], s[inner]]), np.concatenate([end[rest], e[inner]])
            bound = np.concatenate([bound[rest], b[inner]])


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort([ids, -scores])[:k]
    return scores[order], ids[order]


def _names(batch: pa.RecordBatch, i: int) -> pa.LargeStringArray:
    ends, text = batch.column("ends")[i].as_buffer(), batch.column("terms")[i].as_buffer()
    return pa.LargeStringArray.from_buffers(ends.size // 8 - 1, ends, text)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (term, df) of the asked terms of each shard."""
    for batch in batches:
        for i in range(len(batch)):
            asked = batch.column("asked")[i].values
            at = pc.index_in(asked, value_set=_names(batch, i).cast(pa.string()))
            there = at.is_valid()
            place = at.filter(there).to_numpy()
            starts = np.frombuffer(batch.column("starts")[i].as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([asked.filter(there), pa.array(starts[place + 1] - starts[place])], names=["term", "df"])


def _search(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(len(batch)):
                asked = batch.column("asked")[i].values
                items, terms = asked.field("number").to_numpy(), asked.field("term")
                weights = asked.field("weight").to_numpy()
                place = pc.index_in(terms, value_set=_names(batch, i).cast(pa.string())).fill_null(-1).to_numpy()
                starts = np.frombuffer(batch.column("starts")[i].as_buffer(), np.int64)
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), np.int64)
                tree = Tree(batch.column("bits")[i].as_py(), batch.column("impacts")[i].as_py(), batch.column("height")[i].as_py())
                order = np.argsort(items, kind="stable")
                order = order[(place[order] >= 0) & (weights[order] > 0)]
                for part in np.split(order, np.flatnonzero(np.diff(items[order])) + 1) if len(order) else ():
                    own = place[part]
                    item = int(items[part[0]])
                    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    best[item] = tree.best(starts[own], starts[own + 1], weights[part], ids, k, best.get(item, none))
        for item, (scores, ids) in best.items():
            docs = pa.array(ids, mask=ids == _NONE)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), docs, pa.array(scores)], names=["number", "doc_id", "score"])

    return search


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = words(batch.column("text"), TERM)
        yield pa.RecordBatch.from_arrays([batch.column("number").take(pa.array(found.row)), found.array().cast(pa.string())], names=["number", "term"])


def search(shards: DataFrame, n: int, queries: DataFrame, k: int = 20) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the `k` best of the `n` documents of an index for each row (item_id, text) of
    `queries`, a block of them at a time."""
    items = cut(row_numbers(queries.select("item_id", "text").distinct(), [F.col("item_id").asc_nulls_first(), F.col("text").asc_nulls_first()], "number"))
    wanted = cut(items.mapInArrow(_terms, "number long, term string").groupBy("number", "term").agg(F.count("*").alias("times")))
    found = None
    for b in range(-(-items.count() // BLOCK)):
        # at most BLOCK queries and their terms, so the broadcasts are bounded by the longest queries
        block = wanted.where(F.floor(F.col("number") / BLOCK) == b)
        asked = block.agg(F.collect_set("term").alias("asked")).withColumn("block", F.lit(b))
        held = shards.withColumn("block", F.lit(b))
        met = held.select("block", "terms", "ends", "starts").join(F.broadcast(asked), "block").drop("block")
        df = met.mapInArrow(_frequencies, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
        rarity = F.floor(1000 * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")))
        weighted = block.join(df, "term").select(F.struct("number", "term", (rarity * F.col("times")).alias("weight")).alias("x"))
        weighted = cut(weighted.agg(F.collect_list("x").alias("asked")).withColumn("block", F.lit(b)))
        best = held.join(F.broadcast(weighted), "block").drop("block").mapInArrow(_search(k), "number long, doc_id long, score long")
        found = best if found is None else found.union(best)
    if found is None:
        found = wanted.sparkSession.createDataFrame([], "number long, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items, "number").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """As `search`, over an index of `docs` that is written to the shared folder and removed afterwards."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/index-{uuid.uuid4()}"
    shards, n = index(docs)
    shards.write.parquet(folder)
    found = cut(search(spark.read.parquet(folder), n, queries, k))
    _remove(spark, folder)
    return found


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
