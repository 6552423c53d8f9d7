"""License scans by diagonal voting.

Templates, from phrases of two words to whole notices, are cut into k-grams of words; so is every text, whole. The grams of
all texts meet those of the templates in a Spark join. A hit of word p of a text and word t of a template votes for the
diagonal p - t; votes are grouped by text, template and diagonal. Neighbouring diagonals, as words put in or left out make
them, are merged, and every span with enough votes is verified on the words of the text by its edit distance, in words,
from the template. A place counts if at most a fifth of a notice's words are edited, none of a phrase of fewer than LONG
words. Widths of grams and least votes follow from that, so no such place is missed: an edit touches k grams at most.

Words are runs of letters, digits and characters beyond ASCII, with A-Z as a-z. Nulls: a null text is empty, a null id is a
value like any other. Empty texts have no words and no places. Very long texts are read whole. Rows equal in id and text get
equal results. Of places of one template that overlap by so few words that their diagonals are merged, the best counts.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, attach, cut, lean
from .words import Words, classes, hashes, mixed, words


class Template(NamedTuple):
    """A phrase or notice that stands for a license; `base` marks the phrases that are counted apart."""

    label: str
    text: str
    base: bool = False


#: The phrases that are counted, then what this method adds, wordings that licenses themselves prescribe.
TEMPLATES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("epl", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Bytes of words: letters, digits and all beyond ASCII.
WORD = classes(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Words in a gram of a template of fewer than LONG words, and of a longer one.
WIDTHS = (2, 4)
LONG = 16
#: Of so many words of a longer template one may be edited.
LENIENCE = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
SPANS = "array<struct<label:string,base:boolean,start:bigint,n:bigint,likeness:double>>"


def _grams(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams within a row, and their rows."""
    h = hashes(found)
    n = max(0, len(h) - k + 1)
    sums = np.zeros(n, np.uint64)
    for j in range(k):
        sums += h[j : j + n] * _FACTORS[j]
    same = found.row[:n] == found.row[len(h) - n :]
    return mixed(sums[same] + np.uint64(k)).view(np.int64), found.row[:n][same]


def _spelled(text: str) -> list[str]:
    return words(pa.array([text]), WORD).array().to_pylist()


def _width(n: int) -> int:
    return WIDTHS[n >= LONG]


def _by_gram(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts:
        found = words(batch.column("text"), WORD)
        both = [_grams(found, k) for k in WIDTHS]
        rows = np.concatenate([r for _, r in both])
        order = np.argsort(rows, kind="stable")  # a text's short grams, then its long ones
        ends = np.zeros(len(batch) + 1, np.int64)
        np.cumsum(np.bincount(rows, minlength=len(batch)), out=ends[1:])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([g for g, _ in both])[order]))
        short = pa.array(np.bincount(both[0][1], minlength=len(batch)), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), short, lists], names=["doc_id", "h", "short", "grams"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))


def _merged(lines: DataFrame) -> DataFrame:
    """Diagonals that lie no further apart than edits may shift them, as one span each."""
    line = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > F.col("edits"), F.lit(True))
    runs = lines.withColumn("_run", F.sum(apart.cast("long")).over(line))
    met = runs.groupBy("doc_id", "h", "template", "edits", "n", "least", "_run").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen")
    )
    return met.where(F.size("seen") >= F.col("least"))


def candidates(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, h, template, start, stop): spans of words, from `start` up to `stop`, where diagonals have enough votes."""
    spark = docs.sparkSession
    spelled = [_spelled(t.text) for t in templates]
    grams = []
    for i, (t, w) in enumerate(zip(templates, spelled, strict=True)):
        if len(w) < WIDTHS[0]:
            raise ValueError(f"a template needs two words: {t.text!r}")
        found = words(pa.array([t.text]), WORD)
        grams += [(int(g), i, at, len(w)) for at, g in enumerate(_grams(found, _width(len(w)))[0])]
    places = spark.createDataFrame(grams, "gram long, template int, at int, n int").groupBy("gram").agg(F.collect_list(F.struct("template", "at", "n")).alias("places"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut_up = lean(_keyed(docs)).mapInArrow(_by_gram, f"doc_id {kind}, h long, short int, grams array<bigint>")
    hashed = cut_up.select("doc_id", "h", "short", F.posexplode("grams").alias("i", "gram"))
    hits = attach(hashed, cut(places), ["gram"]).where("places is not null").select("doc_id", "h", F.when(F.col("i") < F.col("short"), F.col("i")).otherwise(F.col("i") - F.col("short")).cast("long").alias("p"), F.explode("places").alias("at"))
    edits = F.when(F.col("n") >= LONG, F.floor(F.col("n") / LENIENCE)).otherwise(F.lit(0).cast("long"))
    k = F.when(F.col("n") >= LONG, WIDTHS[1]).otherwise(WIDTHS[0])
    # a template's places are few, so a set of them is small; rows that repeat a text vote once
    lines = hits.groupBy("doc_id", "h", F.col("at.template").alias("template"), F.col("at.n").alias("n"), (F.col("p") - F.col("at.at")).alias("diagonal")).agg(F.collect_set("at.at").alias("seen"))
    lines = lines.withColumn("edits", edits).withColumn("least", F.col("n") + 1 - k - k * F.col("edits"))
    found = _merged(lines.where((F.col("edits") > 0) | (F.size("seen") >= F.col("least"))))
    start, stop = F.greatest(F.lit(0).cast("long"), F.col("low") - F.col("edits")), F.col("high") + F.col("n") + F.col("edits")
    return found.select("doc_id", "h", "template", start.alias("start"), stop.alias("stop"))


def _ends(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance of `pattern` from any run of `text`, and where the first such run ends."""
    n = len(pattern)
    steps = np.arange(n + 1)
    column, best = steps.copy(), (n, 0)
    for j, word in enumerate(text):
        new = np.empty(n + 1, np.int64)
        new[0] = 0
        new[1:] = np.minimum(column[:-1] + (pattern != word), column[1:] + 1)
        column = np.minimum.accumulate(new - steps) + steps  # words left out of the text
        if column[n] < best[0]:
            best = int(column[n]), j + 1
    return best


def _verified(pattern: list[str], text: list[str]) -> tuple[int, int, float] | None:
    """(start, words, likeness) of the place of `pattern` in `text`, if it is near enough."""
    n = len(pattern)
    if n < LONG:
        return (0, n, 1.0) if text == pattern else None
    number = {w: i for i, w in enumerate(dict.fromkeys(pattern))}
    p, t = (np.array([number.get(w, -1) for w in side], np.int64) for side in (pattern, text))
    edits, end = _ends(p, t)
    if edits > n // LENIENCE:
        return None
    back = _ends(p[::-1], t[:end][::-1])[1]
    return end - back, back, 1 - edits / n


def _verify(templates: tuple[Template, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    spelled = [_spelled(t.text) for t in templates]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(batch.column("text"), WORD)
            count = np.bincount(found.row, minlength=len(batch))
            first, spans = np.cumsum(count) - count, []
            flat = found.array()
            for i, places in enumerate(batch.column("places").to_pylist()):
                out = []
                for place in places or ():
                    t, w = templates[place["template"]], spelled[place["template"]]
                    stop = min(place["stop"], int(count[i]))
                    met = _verified(w, flat.slice(int(first[i]) + place["start"], stop - place["start"]).to_pylist())
                    if met:
                        out.append((t.label, t.base, place["start"] + met[0], met[1], met[2]))
                spans.append([dict(zip(("label", "base", "start", "n", "likeness"), x, strict=True)) for x in sorted(out, key=lambda x: (x[2], x[0], x[3]))])
            kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("n", pa.int64()), ("likeness", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(spans, kind)], names=["doc_id", "n_words", "spans"])

    return verify


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, spans) for every row of `docs`: where each template stands, by words from 0, in order.

    Spans to verify are broadcast to the texts while they are few; more are joined by salted keys.
    """
    found = cut(candidates(docs, templates))
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    places = found.groupBy("doc_id", "h").agg(F.collect_list(F.struct("template", "start", "stop")).alias("places"))
    met = attach(_keyed(docs), places, ["doc_id", "h"], BROADCAST_ROWS if few else 0).select("doc_id", "text", "places")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return lean(met).mapInArrow(_verify(templates), f"doc_id {kind}, n_words long, spans {SPANS}")


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def report(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of `docs`; the score
    is the likeness of the best place, 0 without any."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    return scan(docs, templates).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["likeness"])), F.lit(0.0)).alias("score"),
    )
