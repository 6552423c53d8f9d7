"""The corpus pipeline: quality, near-duplicates, personal data, source mix, packing; each stage a whole pass over what
the one before kept, written as Parquet in the shared folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import mixing, packing, quality, setsketch, surrogates
from contrail.llm.shared import read
from contrail.operators.cuts import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects: those with null and blank texts among them, none where
    there are no labels of both kinds. Rows that repeat an id are judged by their own texts, which are read whole; other
    columns stay, whatever their names. An empty table gives an empty result."""
    # a row travels as one column, so that none of its names can clash
    rows = docs.select("text", "source", "lang", "doc_id", F.struct(*docs.columns).alias("_row"))
    return quality.classify(rows, read(spark, sf_dir, "labels")).where("kept").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, 0.8), the one with the smallest id.

    Of rows that repeat an id, each text counts for itself, and one row of each stays; rows without an id or without words
    all stay. Texts are compared whole, and an empty table gives an empty result.
    """
    return setsketch.deduplicate(docs, width=5, threshold=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates and counts the characters again. Null texts stay null, repeated rows are
    treated alike, very long texts are read whole, and other columns stay, whatever their names."""
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    found = surrogates.pseudonymize(rows)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the source mix asks, up to three times: a null source is a source of its own, null
    and empty texts, which have no words, are never taken, and repeated rows are drawn alike. Other columns stay, whatever
    their names. An empty table gives an empty result."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of a power of two of ids, each of one document; a null text gives its end mark alone. sequence_id is
    unique within a run. An empty table gives an empty result."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express a fitted classifier or a tokenizer; the tests compare with a plain version.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder in whatever store it lies."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of a directory; a stage's table goes once the next one's is written, so that one
    table stays, which the result reads."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        out.write.parquet(f"{folder}/{i}")
        if i:
            _remove(spark, f"{folder}/{i - 1}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
