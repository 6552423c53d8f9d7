"""Ranked search, collocations and license scans against plain versions."""

import random
import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import collocations, licenses, wavelets
from contrail.llm import words as w
from contrail.llm.queries import QUERIES
from contrail.llm.shared import read

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
EDGES = [None, "", " ", "A", "\x00a\x0bB c", "été, É!x", "日本 語", "a." * 5000, "x" * 70_000, "İK K", "\U0001f600a\U0001f600 B9"]


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


# -- words ----------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é語 .,\n\t\x00😀", max_size=30)), max_size=8))
def test_words_equal_a_pattern(texts):
    found = w.words(pa.array(texts, pa.string()), wavelets.TERM)
    assert list(zip(found.row.tolist(), found.array().to_pylist(), strict=True)) == [(i, t) for i, x in enumerate(texts) for t in plain_terms(x)]
    found = w.words(pa.array(["skip", *texts], pa.string()).slice(1), collocations.BYTES)
    pieces = [(i, j, t) for i, x in enumerate(texts) for j, p in enumerate(re.split(r"[.,;:!?\n-\r]", (x or "").translate(LOWER))) for t in re.findall(r"[^ \t]+", p)]
    assert found.array().to_pylist() == [p[2] for p in pieces]
    assert found.first.tolist() == [k == 0 or pieces[k][:2] != pieces[k - 1][:2] for k in range(len(pieces))]
    h = w.hashes(found)
    assert len(set(h.tolist())) == len({p[2] for p in pieces})


# -- ranked search --------------------------------------------------------------------------------


def plain_rank(docs, items, k):
    """{(item_id, rank): (doc_id, score)} by going through all documents."""
    held = [(i, Counter(t), len(t)) for i, x in docs if (t := plain_terms(x))]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        asked = Counter(plain_terms(text))
        for doc, c, size in held:
            m = 75 + 25 * size * n // total
            score = sum(q * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("shard", [50, 400, 10**6])
def test_search_equals_going_through_all(spark, monkeypatch, shard):
    monkeypatch.setattr(wavelets, "SHARD_WORDS", shard)
    monkeypatch.setattr(wavelets, "OPENED", 3)
    monkeypatch.setattr(wavelets, "BLOCK", 4)
    rng = random.Random(shard)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in rng.sample(range(-500, 900), 250)]
    docs += [(1000 + i, "the same text w1 w2 w3") for i in range(60)] + [(2000 + i, f"w1 w{i}") for i in range(9)] + [(5, "w1 w7"), (5, "w1 w7"), (None, "w1 w7 w7"), (None, None)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for i in range(9)] + [(20, None), (21, "nowhere"), (22, "The SAME text w1"), (23, "")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("ids", F.lit(0))
    got = wavelets.rank(rows.repartition(3), spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0)), 7)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain_rank(docs, items, 7)))


def test_the_bounds_hold_in_every_node():
    rng = np.random.default_rng(4)
    docs, weight = rng.integers(0, 50, 400), -np.sort(-rng.integers(1, 1000, 400))
    tree = wavelets.Tree(wavelets.layered(docs, 6).tobytes(), weight.astype(np.int32).tobytes(), 6)
    at, number, start, end = 0, 0, 100, 300
    while at < 6:
        inside = docs[100:300] >> (6 - at) == number
        assert end - start == inside.sum() and tree.impacts[at, start] == weight[100:300][inside].max()
        right = bool((docs[100:300][inside] >> (5 - at) & 1).mean() > 0.5)
        before = tree.before[at]
        start, end = (tree.zeros[at] + start - before[start], tree.zeros[at] + end - before[end]) if right else (before[start], before[end])
        at, number = at + 1, 2 * number + right


def test_search_of_edge_rows_and_empty_tables(spark):
    docs = spark.createDataFrame(list(enumerate(EDGES)), "doc_id int, text string")
    items = spark.createDataFrame([(1, "a"), (1, "a"), (1, "B9 x"), (None, "c"), (2, None)], "item_id long, text string")
    got = sorted(map(str, (tuple(r) for r in wavelets.rank(docs, items).collect())))
    assert got == sorted(map(str, plain_rank(list(enumerate(EDGES)), [(1, "a"), (1, "B9 x"), (None, "c"), (2, None)], 20)))
    assert wavelets.rank(docs.limit(0), items).count() == wavelets.rank(docs, items.limit(0)).count() == 0


# -- collocations ---------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=8), st.integers(1, 4))
def test_the_automaton_holds_classes_of_places(pieces, depth):
    ids = np.array([x for p in pieces for x in p])
    linked = np.array([j > 0 for p in pieces for j in range(len(p))])
    places = defaultdict(set)
    at = 0
    for p in pieces:
        for e in range(len(p)):
            for d in range(1, min(depth, e + 1) + 1):
                places[tuple(p[e + 1 - d : e + 1])].add(at + e)
        at += len(p)
    by_places = defaultdict(list)
    for phrase, ends in places.items():
        by_places[frozenset(ends)].append(phrase)
    a = collocations.automaton(ids, linked, depth)
    longest = [tuple(x for x in row[::-1] if x >= 0) for row in a.phrases.tolist()]
    assert {p: (int(n), int(s)) for p, n, s in zip(longest, a.places, a.shortest, strict=True)} == {max(c, key=len): (len(e), min(map(len, c))) for e, c in by_places.items()}
    class_of = {p: max(c, key=len) for c in by_places.values() for p in c}
    for i, p in enumerate(longest):
        target = p[len(p) - a.shortest[i] + 1 :]
        assert (longest[a.link[i]] if a.link[i] >= 0 else ()) == (class_of[target] if target else ())


def plain_collocations(docs, least, share, most):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            t = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(t)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(t[i : i + k]) for i in range(len(t) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:most])]
    return sorted(out)


@pytest.mark.parametrize("shard", [40, 10**6])
def test_collocations_equal_plain_counting(spark, monkeypatch, shard):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    monkeypatch.setattr(collocations, "BITS", (8, 9))  # many false hits
    rng = random.Random(6)
    vocabulary = [f"{c}{int(rng.paretovariate(1))}" for c in "abé語" for _ in range(8)]
    docs = [("".join(rng.choice(vocabulary) + rng.choice("    .\t\n!") for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None])) for _ in range(150)]
    docs += [("New York City new YORK city", "en")] * 12 + [(x, None) for x in EDGES]
    rows = spark.createDataFrame(docs, "text string, lang string")
    for c in ("n", "a", "word", "pair", "phrase", "rank", "words", "key"):
        rows = rows.withColumn(c, F.lit("clash"))
    got = sorted(tuple(r) for r in collocations.collocations(rows.repartition(3), 3, 4, 50, 25).collect())
    assert got == plain_collocations(docs, 4, 50, 25) and any(r[2] == "new york city" for r in got)
    assert collocations.collocations(rows.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    n = 3_000_000_000_001
    rows = spark.createDataFrame([(n, n, n + 1)], "a long, l long, r long")
    assert rows.select(collocations.score().alias("s")).first()["s"] == 10**6 * n * n // (n * (n + 1))


# -- licenses -------------------------------------------------------------------------------------

NOTICE = licenses.TEMPLATES[15].text


def plain_base(text):
    t = plain_terms(text)
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    at = [(i, label) for p, label in phrases.items() for i in range(len(t)) if tuple(t[i : i + len(p)]) == p]
    starts = [i for i, _ in at]
    return len(t), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_licenses_equal_going_through_all(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in read(spark, sf, "documents").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op13_license_diagonals"](spark, sf).collect()}
    assert {k: tuple(r)[1:6] for k, r in got.items()} == {k: plain_base(t) for k, t in docs.items()}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got.values())
    assert {k for k, r in got.items() if "cc-by-nc" in r["labels"]} == {k for k, t in docs.items() if "CC BY-NC 4.0" in (t or "")}


def edited(rng, share):
    t = NOTICE.split()
    for _ in range(int(len(t) * share)):
        i = rng.randrange(len(t))
        t[i : i + rng.choice([0, 1, 1])] = rng.choice([[], ["other"]])
    return " ".join(t)


def test_edited_notices_are_found_where_they_stand(spark):
    rng = random.Random(8)
    fill = lambda n: " ".join(rng.choice(["some", "of", "the", "software", "words"]) for _ in range(n))
    near = [(i, f"{fill(i * 3)} {edited(rng, 0.1)} {fill(20)}") for i in range(30)]
    far = [(100 + i, f"{fill(9)} {edited(rng, 0.9)}") for i in range(10)]
    twice = [(200, f"{fill(7)} {NOTICE} {NOTICE} {fill(3)} the MIT license")]
    got = {r["doc_id"]: r["spans"] for r in licenses.scan(spark.createDataFrame(near + far + twice, "doc_id long, text string")).collect()}
    for i, _ in near:
        assert [s["label"] for s in got[i]] == ["mit"] and abs(got[i][0]["start"] - i * 3) <= 2 and got[i][0]["likeness"] >= 0.8
    assert not any(got[i] for i, _ in far)
    n = len(plain_terms(NOTICE))
    assert [(s["start"], s["n"], s["likeness"]) for s in got[200]] == [(7, n, 1.0), (7 + n, n, 1.0), (11 + 2 * n, 2, 1.0)]


def test_license_edge_rows(spark, monkeypatch):
    rows = [*enumerate(EDGES), (None, "mit license"), (None, "mit license"), (None, "x mit license"), (3, "MIT-License\nGNU Lesser General Public License mit license"), (None, "mit license " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("h", "p", "n", "places", "spans", "start", "gram", "template"):
        docs = docs.withColumn(c, F.lit("clash"))
    for most in (10**5, 1):
        monkeypatch.setattr(licenses, "BROADCAST_ROWS", most)
        got = licenses.report(docs).collect()
        assert sorted(map(str, ((r["doc_id"], *tuple(r)[1:6]) for r in got))) == sorted(map(str, ((i, *plain_base(t)) for i, t in rows)))
        assert [r["labels"] for r in got if r["n_base"] == 3] == ["gpl,lgpl,mit"]
    assert licenses.report(docs.limit(0)).count() == 0
