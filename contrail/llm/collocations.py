"""Phrase collocations from suffix automata.

A shard is what a task has read until it holds SHARD_WORDS words. For each language of a shard a generalised suffix automaton of
its pieces, down to a bounded depth, is laid out in arrays: its states are the classes of phrases that end at the same
places, each with its longest and shortest phrase, the number of its places, and a suffix link. The links' tree is the
tree of all pieces read backwards from each place, so sorting the places by their words from the last to the first lays
it out whole, with no step per word. A state's phrases are enumerated, and counts are summed over shards by grouping.

A phrase is as frequent as its least frequent pair of words at most, so only what can be frequent travels as text: a first
pass counts words, and pairs of words by 64-bit hashes; the hashes of frequent pairs, as a bitmap of bounded size, cut the
pieces of the second pass, whose automata count phrases by their text. A false hit of the bitmap costs a row and changes nothing.

A longer candidate subsumes the phrases that its suffix link and its mirror lead to, those without its first or last word,
if its count comes near theirs; what a still longer one would subsume, these subsume too, as they are as frequent at least.

Nulls: a null text is empty, a null language is `und`. Repeated rows and ids count each; ids are not read. Empty texts have
no words. Very long texts are read whole. Ties in rank are settled by count and then by the phrase's bytes, which differ.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, cut, lean, look_up
from .words import Words, classes, hashed, mixed, words

#: Bytes between words and between pieces.
BYTES = classes(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Words of a shard, which bound a task's memory; a longer text makes a longer shard.
SHARD_WORDS = 1_000_000
#: Rows of a batch that a task gives.
ROWS = 50_000
#: Bits of the map of frequent pairs, as powers of two: at least, and at most (32 MB).
BITS = (16, 28)
#: Parts of a language that are ranked apart first.
SALTS = 64
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Pieces(NamedTuple):
    """A shard's words in one language: their numbers, the texts of the numbers, whether a piece starts, and a hash of each
    word with the one before."""

    ids: np.ndarray
    names: pa.LargeStringArray
    first: np.ndarray
    pairs: np.ndarray


class Automaton(NamedTuple):
    """States of a suffix automaton: their longest phrase, as word numbers from its last word backwards (-1: none), its length, the
    shortest one's, the number of places, and the state that the suffix link leads to (-1: the root)."""

    phrases: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray
    places: np.ndarray
    link: np.ndarray


def _hashes(names: pa.LargeStringArray) -> np.ndarray:
    ends = np.frombuffer(names.buffers()[1], np.int64)[: len(names) + 1]
    return hashed(np.frombuffer(names.buffers()[2] or b"", np.uint8)[: ends[-1]], np.diff(ends))


def _pieces(lang: str, found: list[Words]) -> Pieces:
    whole = Words(*(np.concatenate([w[i] for w in found]) for i in range(4)))
    coded = whole.array().dictionary_encode()
    ids, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    seed = np.frombuffer(lang.encode(), np.uint8)
    h = _hashes(names)[ids]
    pairs = np.zeros(len(ids), np.uint64)
    own = hashed(seed, np.array([len(seed)])) if len(seed) else np.uint64(0)
    pairs[1:] = mixed(h[:-1] * _LEFT + h[1:] * _RIGHT + own)
    return Pieces(ids, names, whole.first, pairs)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Pieces]]:
    """The languages of each shard of a task's rows (text, lang)."""
    held: dict[str, list[Words]] = {}
    total = 0
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            found = words(batch.filter(pc.equal(batch.column("lang"), lang)).column("text"), BYTES)
            if len(found.lengths):
                held.setdefault(lang, []).append(found)
                total += len(found.lengths)
        if total >= SHARD_WORDS:
            while held:
                lang, found = held.popitem()
                yield lang, _pieces(lang, found)
            total = 0
    while held:
        lang, found = held.popitem()
        yield lang, _pieces(lang, found)


def automaton(ids: np.ndarray, linked: np.ndarray, depth: int) -> Automaton:
    """The suffix automaton of the phrases of up to `depth` words in `ids`; `linked` says which words follow the one before in a
    piece."""
    columns, alive = [ids], np.ones(len(ids), bool)
    for d in range(1, depth):
        # whether the word d places before, which is a piece's, still belongs to the same piece
        alive = alive & np.append(np.zeros(d - 1, bool), linked)[: len(ids)]
        columns.append(np.where(alive, np.append(np.full(d, -1), ids)[: len(ids)], -1))
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    n = len(ids)
    new = np.zeros(n, bool)
    new[:1] = True
    starts, counts, parents, shortest, heads = [], [], [], [], []
    merged: list[np.ndarray] = []
    for d, c in enumerate(columns):
        new[1:] |= c[1:] != c[:-1]
        runs = np.flatnonzero(new)
        sizes = np.diff(np.append(runs, n))
        real = c[runs] >= 0
        starts.append(runs[real])
        counts.append(sizes[real])
        merged.append(np.zeros(len(starts[-1]), bool))
        if not d:
            parents.append(np.full(len(starts[0]), -1))
            shortest.append(np.ones(len(starts[0]), np.int64))
            heads.append(parents[0])
            continue
        parent = np.searchsorted(starts[d - 1], starts[d], "right") - 1
        same = counts[d - 1][parent] == counts[d]  # ends where the phrase without its first word ends
        merged[d - 1][parent[same]] = True
        parents.append(parent)
        shortest.append(np.where(same, shortest[d - 1][parent], d + 1))
        # the node above the shortest phrase, by depth and place
        heads.append(np.where(same, heads[d - 1][parent], parent * depth + d - 1))
    state: list[np.ndarray] = [np.empty(0, np.int64)] * depth
    first = np.cumsum([0] + [int((~m).sum()) for m in merged])
    for d in reversed(range(depth)):
        state[d] = np.full(len(starts[d]), -1)
        state[d][~merged[d]] = first[d] + np.arange(first[d + 1] - first[d])
        if d + 1 < depth:
            child = np.flatnonzero(counts[d][parents[d + 1]] == counts[d + 1])
            state[d][parents[d + 1][child]] = state[d + 1][child]
    above = np.concatenate([h[~m] for h, m in zip(heads, merged, strict=True)])
    link = np.full(len(above), -1)
    for d in range(depth):
        at = (above >= 0) & (above % depth == d)
        link[at] = state[d][above[at] // depth]
    keep = [s[~m] for s, m in zip(starts, merged, strict=True)]
    phrases = np.full((len(above), depth), -1)
    for d in range(depth):
        for j in range(d + 1):
            phrases[first[d] : first[d + 1], j] = columns[j][keep[d]]
    longest = np.repeat(np.arange(1, depth + 1), np.diff(first))
    return Automaton(phrases, longest, *(np.concatenate([x[~m] for x, m in zip(y, merged, strict=True)]) for y in (shortest, counts)), link)


def _batches(names: list[str], arrays: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    for i in range(0, len(whole), ROWS):
        yield whole.slice(i, ROWS)


def _first_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word, pair, n) of a shard: words, pairs by their hash (no lang), and all words of the language (no word)."""
    for lang, p in _shards(batches):
        n = np.bincount(p.ids, minlength=len(p.names))
        pairs, times = np.unique(p.pairs[~p.first], return_counts=True)
        langs = pa.array([lang], pa.string())
        names = ["lang", "word", "pair", "n"]
        yield pa.RecordBatch.from_arrays([langs, pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([len(p.ids)])], names=names)
        yield from _batches(names, [pa.repeat(lang, len(n)).cast(pa.string()), p.names.cast(pa.string()), pa.nulls(len(n), pa.int64()), pa.array(n)])
        yield from _batches(names, [pa.nulls(len(times), pa.string()), pa.nulls(len(times), pa.string()), pa.array(pairs.view(np.int64)), pa.array(times)])


def _counted(bitmap, depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (lang, phrase, shortest, longest, n): the states of each shard's automata of what frequent pairs link."""

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        mask = np.uint64(len(bits) * 8 - 1)
        for lang, p in _shards(batches):
            at = p.pairs & mask
            linked = ~p.first & ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            linked[:1] = False
            inside = linked | np.append(linked[1:], False)
            a = automaton(p.ids[inside], linked[inside], depth)
            many = a.longest > 1
            spelled = [p.names.take(pa.array(c[many], mask=c[many] < 0)) for c in a.phrases.T[::-1]]
            phrases = pc.binary_join_element_wise(*spelled, pa.scalar(" ", pa.large_string()), null_handling="skip").cast(pa.string())
            shortest = np.maximum(a.shortest[many], 2).astype(np.int32)
            columns = [pa.repeat(lang, len(phrases)).cast(pa.string()), phrases, pa.array(shortest), pa.array(a.longest[many].astype(np.int32)), pa.array(a.places[many])]
            yield from _batches(["lang", "phrase", "shortest", "longest", "n"], columns)

    return states


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """The pairs' hashes as bits; at most 2 ** BITS[1] of them come to the driver, however many pairs there are."""
    size = min(BITS[1], max(BITS[0], (32 * pairs.count()).bit_length()))
    bit = F.col("pair").bitwiseAND(F.lit((1 << size) - 1)) + 1
    made = pairs.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bits = np.zeros((1 << size) // 8, np.uint8)
    for row in made.toLocalIterator():
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(bits) - at]
    return bits


def _part(count: Column) -> Column:
    """A phrase's first `count` words, or its last ones where that is negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), count.cast("int"))


def counts(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(counts, totals): rows (lang, phrase, words, n) of all phrases of up to `longest` words that occur `least` times, and rows
    (lang, n) of all words of a language."""
    texts = lean(docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")))
    grouped = texts.mapInArrow(_first_counts, "lang string, word string, pair long, n long").groupBy("lang", "word", "pair").agg(F.sum("n").alias("n"))
    once = cut(grouped.where((F.col("n") >= least) | (F.col("word").isNull() & F.col("pair").isNull())))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(once.where("pair is not null").select("pair")))
    states = texts.mapInArrow(_counted(bitmap, longest), "lang string, phrase string, shortest int, longest int, n long")
    every = states.select("lang", "phrase", F.explode(F.sequence("shortest", "longest")).alias("words"), "n")
    suffix = _part(-F.col("words"))
    phrases = every.groupBy("lang", suffix.alias("phrase"), "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = once.where("word is not null").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return cut(single.union(phrases)), once.where("word is null and pair is null").select("lang", "n")


def _subsumed(found: DataFrame, share: int) -> DataFrame:
    """Rows (lang, phrase): what a longer candidate holds that has `share` per cent of its count or more."""
    ends = F.array(_part(1 - F.col("words")), _part(F.col("words") - 1))
    inside = found.where("words > 2").select("lang", F.explode(ends).alias("phrase"), "n")
    most = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    return found.join(most, ["lang", "phrase"]).where(F.col("longer") * 100 >= F.col("n") * share).select("lang", "phrase")


def _joined(cuts: DataFrame, known: DataFrame, side: str, name: str, total: int) -> DataFrame:
    """`cuts` with the count of the part `side`; a part of very many phrases, such as an article, meets them by broadcast."""
    uses = cuts.groupBy(side).agg(F.count("*").alias("uses"))
    small = cut(known.withColumnsRenamed({"key": side, "n": name}).join(uses, side))
    return look_up(cuts, small, side, "uses", total)


def score() -> Column:
    """1,000,000 a * a div (l * r), by decimals of 38 digits: exact for counts of up to fifteen, beyond which the cast raises."""
    wide = "cast({} AS decimal(15,0))".format
    return F.expr(f"({wide('a')} * {wide('a')} * cast(1000000 AS decimal(7,0))) div ({wide('l')} * {wide('r')})")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, most: int = 2000) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's first `most` phrases of two to `longest` words."""
    known, totals = counts(docs, longest, least)
    found = known.where("words > 1")
    kept = found.join(_subsumed(found, share), ["lang", "phrase"], "left_anti")
    key = lambda part: F.concat_ws("\t", "lang", part)  # noqa: E731  no word holds a tab
    left = _part(F.col("k"))
    right = _part(F.col("k") - F.col("words"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cut(cuts.select("lang", "phrase", F.col("n").alias("a"), "k", key(left).alias("left"), key(right).alias("right")))
    keyed = known.select(F.concat_ws("\t", "lang", "phrase").alias("key"), "n")
    total = cuts.count()
    met = cut(_joined(cuts, keyed, "left", "l", total))
    met = _joined(met, keyed, "right", "r", total)
    lowest = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score().alias("score"), "k", "l", "r")).alias("x"))
    rows = lowest.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    return attach(_first(rows, most), totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first(rows: DataFrame, most: int) -> DataFrame:
    """The first rows of each language, ranked in parts first, so that no task orders a whole language."""
    order: list[Column] = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= most)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
