"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from contrail.llm import htmltext, mixing, packing, projections, quality, setsketch, sharding, surrogates, syncmers, urlrules
from contrail.llm.shared import cut

LONG = "word " * 60_000 + "x" * 50_000 + " Mr 7 a@ " + "y." * 20_000 + " :: 12-34 " + "z" * 50_000
TEXTS = [(1, "a b c d e f g", "en", "s"), (1, "a b c d e f g", "en", "s"), (2, None, None, None), (3, "", "de", None), (4, LONG, "en", "s"), (None, "mail me at a.b@c.example.com now", "en", "t"), (5, " \n\t ", "en", "t"), (6, "日本語テキスト 😀", None, "t")]
CLASHES = ["size", "kept", "host", "path", "evidence", "probability", "n", "rank", "base", "entities", "target", "taken", "class", "id", "bucket", "number", "start", "length", "label", "rule", "verdict", "copies", "extra", "source_size", "anchors", "fingerprint", "part", "guest"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    for c in CLASHES:
        rows = rows.withColumn(c, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 0), (99, 1, 0), (None, 0, 0), (3, None, None), (2, 7, 0)], "doc_id long, quality int, toxic int")


def ops(labels):
    return {
        "quality": lambda d: quality.classify(d, labels).select("doc_id", "probability", "kept"),
        "mixing": lambda d: (lambda s: mixing.mixed(s, mixing.plan(s)))(cut(mixing.sized(d))).select("doc_id", "size", "taken"),
        "mix": mixing.mix,
        "packing": packing.digest,
        "pack": packing.pack,
        "sharding": sharding.shard,
        "syncmers": syncmers.compared,
        "fingerprints": lambda d: syncmers.fingerprints(d).select("doc_id", "fingerprint"),
        "setsketch": setsketch.near_duplicates,
        "surrogates": surrogates.pseudonymize,
    }


@pytest.mark.parametrize("name", ["quality", "mixing", "mix", "packing", "pack", "sharding", "syncmers", "fingerprints", "setsketch", "surrogates"])
def test_documents(spark, docs, labels, name, tmp_path):
    op = ops(labels)[name]
    op(docs).write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("doc_id = 4").count() > 0
    if name not in ("mix", "packing", "pack"):
        assert got.count() == len(TEXTS)
    assert op(docs.limit(0)).count() == 0


def test_defined_results(spark, docs, labels):
    q = {(r["doc_id"], r["kept"]) for r in quality.classify(docs, labels).where("doc_id in (2, 3, 5)").collect()}
    assert q == {(2, False), (3, False), (5, False)}
    none = quality.classify(docs, labels.limit(0)).select("doc_id", "kept", "probability").collect()
    assert {r["kept"] for r in none if r["doc_id"] in (1, 4, 6)} == {True}
    near = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(docs, 4).where("doc_id is null or doc_id < 4").collect()}
    assert near == {(1, 4, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 2, None, True)}
    packed = packing.digest(docs).where("doc_id in (2, 3)").select("doc_id", "length", "doc_tokens").collect()
    assert sorted(map(tuple, packed)) == [(2, 1, 1), (3, 1, 1)]
    shards = {(r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.shard(docs).where("doc_id in (2, 3)").collect()}
    assert shards == {(2, 8, 0), (3, 8, 0)}
    prints = {r["doc_id"]: r["fingerprint"] for r in syncmers.fingerprints(docs).collect()}
    assert prints[2] == prints[3] == prints[5] == "" and prints[6] != ""
    hidden = {r["doc_id"]: r["text"] for r in surrogates.pseudonymize(docs).collect()}
    assert hidden[2] is None and hidden[3] == "" and hidden[4] == LONG and "a.b@c.example" not in hidden[None]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(cut(mixing.sized(docs)), mixing.plan(cut(mixing.sized(docs)))).collect()}
    assert taken[2] == taken[3] == taken[5] == 0


def test_pages(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "no host", "<p>x"), (None, "https://A.EXAMPLE.net/en/x?y#z", "<article><p>" + "long text here. " * 20_000 + "</p></article>"), (3, "no host", "<p>x")], "page_id long, url string, html string")
    for c in ("host", "path", "rule", "verdict", "globs", "text", "n_chars", "_v"):
        rows = rows.withColumn(c, F.lit(0))
    got = urlrules.judge(rows).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (3, "", "", None, "allow"), (None, "a.example.net", "/en/x", "example.net/en/", "allow")]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    long = rows.limit(1).withColumn("url", F.lit("http://a.example/" + "b" * 300_000))
    assert urlrules.judge(long).first()["path"] == "/" + "b" * 300_000
    texts = {r["page_id"]: r["n_chars"] for r in htmltext.extract(rows).collect()}
    assert texts[1] == texts[2] == 0 and texts[None] == len("long text here. " * 20_000) - 1
    assert urlrules.judge(rows.limit(0)).count() == htmltext.extract(rows.limit(0)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("node", "length", "vector", "n", "component", "pass"):
        v = v.withColumn(c, F.lit("clash"))
    got = sorted((tuple(r) for r in projections.near_duplicates(v).collect()), key=str)
    want = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)] + [(1, 4, 1, True), (2, 4, 1, False), (12, 4, 1, False), (12, 4, 1, False), (None, 4, None, True)]
    assert got == sorted(want, key=str)
    assert projections.near_duplicates(v.limit(0)).count() == 0
