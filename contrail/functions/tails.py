"""Misread registrations: a weighted edit distance and spelling variants, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Pairs of characters that optical reading takes for each other.
CONFUSED = ("0O", "0Q", "0D", "1I", "1L", "1l", "1|", "2Z", "3B", "4A", "5S", "6G", "6b", "7T", "8B", "9g", "9q")
# A character, and those that it may be read as.
READ_AS = {
    "0": "OQD",
    "1": "ILlTJ|",
    "2": "Z",
    "3": "B",
    "4": "A",
    "5": "S",
    "6": "Gb",
    "7": "T",
    "8": "B",
    "9": "gq",
    "B": "83",
    "D": "0O",
    "G": "6",
    "I": "1l",
    "L": "1",
    "O": "0Q",
    "Q": "0O",
    "S": "5",
    "T": "17",
    "Z": "2",
}
#: Classes of confused characters: each character and the one that stands for its class.
FOLD_FROM, FOLD_TO = "OQDILl|Z3BASGbTgq", "00011112884566799"
#: Places of a text, from its start, that `variants` changes, so that it does not write out too many.
PLACES = 4


def folded(text: Column) -> Column:
    """Each character as one of its class."""
    return F.translate(text, FOLD_FROM, FOLD_TO)


def deletions(text: Column, most: int = 2) -> Column:
    """The text, and what is left of it without one or `most` (two at most) of its characters: texts within `most` edits share one
    of them."""
    n = F.length(text)

    def without(t: Column, i: Column) -> Column:
        return F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1))

    every = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    one = F.transform(every, lambda i: without(text, i))
    two = F.flatten(F.transform(every, lambda i: F.transform(F.filter(every, lambda j: j < i), lambda j: without(without(text, i), j))))
    return F.array_distinct(F.concat(F.array(text), *[one, two][:most]))


def one_edit_keys(text: Column, other: bool = False) -> Column:
    """What two texts, the second one's with `other`, have in common if and only if at most one edit parts them: with a place, what is left
    without the character there; and what is left of one without a character, which is the whole other. Unequal ones share one key."""
    n = F.length(text)
    every = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    left = F.transform(every, lambda i: F.concat(i.cast("string"), F.lit(":"), F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))
    less = F.filter(deletions(text, 1), lambda t: F.length(t) < n)
    shorter = F.transform(less, lambda t: F.concat(F.lit("+:" if other else "-:"), t))
    return F.concat(left, shorter, F.array(F.concat(F.lit("-:" if other else "+:"), text)))


def exchanged(text: Column) -> Column:
    """The texts that have one of two confused characters for the other at one place of `text`."""
    like: dict[str, str] = {}
    for x, y in CONFUSED:
        like[x], like[y] = like.get(x, "") + y, like.get(y, "") + x
    table = F.create_map(*[F.lit(x) for kv in like.items() for x in kv])
    n = F.length(text)
    every = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def at(i: Column) -> Column:
        more = F.element_at(table, F.substr(text, i, F.lit(1)))
        return F.transform(F.when(more.isNotNull(), F.split(more, "")).otherwise(F.array().cast("array<string>")), lambda c: F.concat(F.substr(text, F.lit(1), i - 1), c, F.substr(text, i + 1)))

    return F.array_distinct(F.flatten(F.transform(every, at)))


def weighted_distance(a: Column, b: Column) -> Column:
    """Edit distance in which taking one of two confused characters for the other costs a half."""
    x, y = F.split(a, ""), F.split(b, "")
    pairs = F.array(*[F.lit(p) for c in CONFUSED for p in (c, c[::-1])])

    def row(before: Column, c: Column) -> Column:
        def cell(now: Column, j: Column) -> Column:
            d = F.get(y, j)
            cost = F.when(c == d, 0.0).when(F.array_contains(pairs, F.concat(c, d)), 0.5).otherwise(1.0)
            best = F.least(F.get(before, j + 1) + 1.0, F.element_at(now, -1) + 1.0, F.get(before, j) + cost)
            return F.concat(now, F.array(best))

        return F.aggregate(F.sequence(F.lit(0), F.size(y) - 1), F.array(F.get(before, 0) + 1.0), cell)

    start = F.transform(F.sequence(F.lit(0), F.size(y)), lambda j: j.cast("double"))
    return F.element_at(F.aggregate(x, start, row), -1)


def with_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seen, tail) of a task with `distance`, the weighted distance of the two, all pairs of a batch at once."""
    half = np.zeros((128, 128), bool)
    for x, y in CONFUSED:
        half[ord(x), ord(y)] = half[ord(y), ord(x)] = True
    for batch in batches:
        if not len(batch):
            continue
        a, b = (np.array(batch.column(c).to_pylist(), dtype=np.str_) for c in ("seen", "tail"))
        x, y = (np.ascontiguousarray(t).view(np.uint32).reshape(len(t), -1) for t in (a, b))
        ends, stops = np.char.str_len(a), np.char.str_len(b)
        row = np.tile(np.arange(y.shape[1] + 1, dtype=float), (len(a), 1))
        every = np.arange(len(a))
        out = row[every, stops]
        for i in range(x.shape[1]):
            now = np.empty_like(row)
            now[:, 0] = i + 1
            c = x[:, i]
            for j in range(y.shape[1]):
                d = y[:, j]
                like = half[np.minimum(c, 127), np.minimum(d, 127)] & (c < 128) & (d < 128)
                cost = np.where(c == d, 0.0, np.where(like, 0.5, 1.0))
                now[:, j + 1] = np.minimum(np.minimum(row[:, j + 1], now[:, j]) + 1.0, row[:, j] + cost)
            row = now
            out = np.where(ends == i + 1, row[every, stops], out)
        yield pa.RecordBatch.from_arrays([batch.column("seen"), batch.column("tail"), pa.array(out)], names=["seen", "tail", "distance"])


def variants(text: Column) -> Column:
    """The spellings of a text, its first PLACES doubtful characters read as themselves or as those they are taken for."""
    table = F.create_map(*[F.lit(x) for kv in READ_AS.items() for x in kv])

    def step(state: Column, c: Column) -> Column:
        more = F.when(state["used"] < PLACES, F.element_at(table, c))
        readings = F.when(more.isNotNull(), F.split(F.concat(c, more), "")).otherwise(F.array(c))
        grown = F.flatten(F.transform(state["texts"], lambda t: F.transform(readings, lambda r: F.concat(t, r))))
        return F.struct(grown.alias("texts"), (state["used"] + more.isNotNull().cast("int")).alias("used"))

    start = F.struct(F.array(F.lit("")).alias("texts"), F.lit(0).alias("used"))
    return F.aggregate(F.split(F.upper(text), ""), start, step, lambda s: F.array_distinct(s["texts"]))


def form(text: Column) -> Column:
    """Each character as one of all that READ_AS links it with, through others too: a text and its variants have one form."""
    return F.translate(folded(text), "7J", "11")


def reads_as(text: Column, other: Column) -> Column:
    """Whether `other` is `text` with any of its doubtful characters, however many, read as one of those they are taken for."""
    table = F.create_map(*[F.lit(x) for kv in READ_AS.items() for x in kv])
    both = F.zip_with(F.split(F.upper(text), ""), F.split(other, ""), lambda c, o: F.struct(c.alias("c"), o.alias("o")))
    same = lambda x: (x["c"] == x["o"]) | F.coalesce(F.contains(F.element_at(table, x["c"]), x["o"]), F.lit(False))
    return (F.length(text) == F.length(other)) & F.forall(both, same)


def plausible(seen: Column, tail: Column, distance: Column) -> Column:
    """Whether a distance may come of misreading: it counts a confused pair, or nothing but characters lost or added. A plain
    exchange, such as of 9 for 4, is another tail."""
    return (distance % 1 > 0) | (F.abs(F.length(seen) - F.length(tail)) >= F.floor(distance))
