"""Many names in texts against brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from contrail.functions import text
from contrail.operators import patterns
from contrail.plans import matching, places, scorers
from contrail.plans.mapping import table


@pytest.mark.parametrize("block", [12, 10**6])
def test_contained_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(patterns, "BLOCK_CHARS", block)
    rng = random.Random(1)
    texts = [(i, "".join(rng.choices("abé😀", k=rng.randint(0, 12)))) for i in range(80)] + [(80, None), (80, "a"), (80, "a")]
    names = [(i, "".join(rng.choices("abé😀", k=rng.randint(0, 3)))) for i in range(20)] + [(99, None)]
    got = patterns.contained(spark.createDataFrame(texts, "id int, t string"), "t", spark.createDataFrame(names, "ord int, v string"), "v")
    want = sorted((i, t, o, v) for i, t in texts for o, v in names if t and v and v in t)
    assert got.columns == ["id", "t", "ord", "v"] and sorted(map(tuple, got.collect())) == want
    none = spark.createDataFrame([], "ord int, v string")
    assert patterns.contained(spark.createDataFrame(texts, "id int, t string"), "t", none, "v").count() == 0


def test_fifty_thousand_names_over_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rng = random.Random(2)
    texts = [r["text"] for r in docs.collect()]
    names = set()
    while len(names) < 50_000:
        t = rng.choice(texts)
        i = rng.randrange(max(1, len(t) - 12))
        names.add(t[i : i + rng.randint(9, 12)])
    got = patterns.contained(docs, "text", spark.createDataFrame([(n,) for n in sorted(names)], "name string"), "name")
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    some = docs.orderBy("doc_id").limit(12).collect()
    assert {r["doc_id"]: sum(n in r["text"] for n in names) for r in some} == {r["doc_id"]: counts.get(r["doc_id"], 0) for r in some}


@pytest.mark.parametrize("query", [matching.alias_containment, matching.token_subset_match, matching.alias_mentions, places.operator_lookup, scorers.registry_audit])
def test_no_query_of_names_compares_all_pairs(spark, sf, query):
    plan = query(spark, sf)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upper_case_goes_letter_by_letter(spark):
    got = spark.createDataFrame([("groß ﬁx ʼné ı",)], "t string").select(text.upper_each(F.col("t")).alias("u")).first()["u"]
    assert got == "GRO\ufffd \ufffdX ʼNÉ I"


def test_alias_mentions_with_sharp_s_equal_sql(spark, tmp_path):
    rows = [(1, "x " * 20 + "die größte aufgabe"), (2, "x " * 20 + "DIE GRÖSSTEN aufgaben"), (3, "x " * 20 + "verheissungen"), (4, "ﬁnanzierung " * 21), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "verheißungen aufgabenheißt finanzierung"), (2, "ungheitßen aufgabenheft")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(tuple(r) for r in matching.alias_mentions(spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(matching.ORACLE["alias_mentions"]).fetchall()) and got


def test_common_names_meet_by_their_counts(spark, tmp_path):
    rows = [(i, "hot bolt") for i in range(2000)] + [(3000, "no8"), (3001, "lamp"), (3002, "noB")]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = matching.confusable_registry_match(spark, str(tmp_path))
    # both sides of the join are not the rows: one is grouped by the key first
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(3001, 3001)] and plan.index("Join") < plan.rindex("Aggregate")


def test_parts_of_a_name(spark):
    rows = spark.createDataFrame([("aba",), ("",), (None,)], "n string")
    assert sorted(r["p"] for r in patterns.parts_of(rows, "n", "p").collect()) == ["a", "ab", "aba", "b", "ba"]
