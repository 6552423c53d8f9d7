"""The corpus pipeline against its parts, and what each stage promises."""

import re

import corpus_pipeline as pipeline
from contrail.llm import mixing, packing, quality, surrogates
from contrail.llm.shared import read

from .test_methods import alike, linked, word_sets


def test_stages_in_turn(spark, sf, tmp_path):
    docs = start = read(spark, sf, "documents")
    kept = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept[i] = docs
        if i < 4:
            assert docs.columns == start.columns, name
    good = {r["doc_id"] for r in quality.classify(start, read(spark, sf, "labels")).where("kept").collect()}
    assert {r["doc_id"] for r in kept[0].collect()} == good
    texts = {r["doc_id"]: r["text"] for r in kept[0].collect()}
    want = linked(word_sets(texts, 5), alike)
    assert sorted(r["doc_id"] for r in kept[1].collect()) == sorted(k for k, c in want.items() if k == c)
    for r in kept[2].collect():
        assert r["text"] == surrogates.replaced(texts[r["doc_id"]])[0] and r["n_chars"] == len(r["text"])
    words = sum(len(re.findall(r"\S+", r["text"])) for r in kept[2].collect())
    assert abs(sum(len(re.findall(r"\S+", r["text"])) for r in kept[3].collect()) - words) < 0.2 * words
    encode = packing.Encoder(packing.tokenizer_path())
    assert sum(r["length"] for r in kept[4].collect()) == sum(len(encode(r["text"])) + 1 for r in kept[3].collect())
    assert mixing.MOST == 3.0


def test_run_gives_the_last_stage(spark, sf):
    rows = pipeline.run(spark, sf)
    assert rows.where("size(ids) <> length").count() == 0 and rows.count() > 100


def test_repeated_and_null_ids(spark, sf):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "en", "s", 15), (1, "a b c d e f g h", "en", "s", 15), (2, "a b c d e f g h", "en", "s", 15), (None, "x y z", "en", "s", 5), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted(map(str, (r["doc_id"] for r in out.collect()))) == ["1", "None", "None"]
    other = spark.createDataFrame([(1, "q r s t u v w x", "en", "s", 15), (2, "a b c d e f g h", "en", "s", 15), (1, "a b c d e f g h", "de", "s", 15)], docs.schema)
    kept = pipeline.drop_near_duplicates(spark, docs.unionByName(other), sf).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["lang"] or "") for r in kept) == [(0, "", ""), (0, "x y z", "en"), (1, "a b c d e f g h", "de"), (1, "q r s t u v w x", "en")]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
