"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding.

A document of n ids (its tokens and an end mark) is cut into floor(n / most) pieces of the full length and one piece for
each bit of the rest, longest first. Every piece is a sequence of its own; sequences of one length form a bucket, and a
batch is drawn from one bucket. Sequences are numbered without gaps, bucket after bucket.

Nulls: a null text is empty and gives the end mark alone; a null id is a value. Repeated rows give repeated pieces, each
with a sequence of its own. An empty table gives an empty result. Texts are tokenized whole, however long.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, cut, lean, written_out

#: Longest sequence, a power of two.
MOST = 2048
#: The id after each document.
END = 1
#: Documents whose pieces a task holds at a time.
LOT = 500
#: Pieces for each block of the numbering.
BLOCK_ROWS = 50_000

_PIECE = "start long, length long, ids_crc32 long, doc_tokens long"

def tokenizer_path() -> str:
    """Where the default vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts by the vocabulary in a tokenizer file, a byte-level BPE.

    The file is read by `tokenizers`, whose ids are the measure; the ranks in it drive tiktoken's merges, which give
    the same ids several times faster. A special token of the file is one id where it stands in a text, as `tokenizers`
    has it. `reference` gives the ids of `tokenizers` itself, and the tests compare them.
    """

    def __init__(self, path: str):
        import public_tokenizers
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        # the printable stand-ins of the 256 bytes: visible Latin-1 stands for itself, others from 256 up
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t.content: i for i, t in self.model.get_added_tokens_decoder().items()}
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in self.model.get_vocab().items() if token not in special
        }
        self.fast = Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def reference(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.fast.encode(text, allowed_special="all"), dtype=np.uint32)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


def cuts(total: int, most: int = MOST) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, then the bits of the rest, longest first."""
    out = [(i * most, most) for i in range(total // most)]
    at = total - total % most
    for bit in range(most.bit_length() - 2, -1, -1):
        if total >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pieces(docs: DataFrame, path: str | None = None, most: int = MOST, end: int = END, with_ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids): the pieces of every document."""
    where = path or tokenizer_path()
    docs = lean(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(where)
        for batch in (b.slice(i, LOT) for b in batches for i in range(0, b.num_rows, LOT)):
            keys, rows, ids_of = [], [], []
            texts = batch.column("text")
            for i in range(batch.num_rows):
                ids = np.append(encode(texts[i].as_py() or ""), np.uint32(end)).astype("<u4")
                for start, length in cuts(len(ids), most):
                    part = ids[start : start + length]
                    keys.append(i)
                    rows.append((start, length, zlib.crc32(part.tobytes()), len(ids)))
                    ids_of.append(part.astype(np.int32))
            table = np.array(rows, dtype=np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id").take(pa.array(keys, pa.int64()))] + [pa.array(c) for c in table.T]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(table[:, 1])]).astype(np.int32)
                flat = np.concatenate([*ids_of, np.zeros(0, np.int32)])
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(
        cut_up, f"doc_id {kind}, {_PIECE}" + ", ids array<int>" * with_ids
    )


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` of pieces with sequence_id: 0..N-1 over the buckets of equal length, fixed by the values of the rows.

    Equal rows are counted first and numbered together, so that none fills a task. Rows are dealt to blocks by hash; a
    window numbers each block and bucket, and the blocks before (few rows) give its offset.
    """
    kinds = cut(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")))
    many, most = kinds.agg(F.count("*"), F.coalesce(F.max("_n"), F.lit(0))).first()
    blocks = max(1, -(-many // BLOCK_ROWS))
    placed = kinds.withColumn("_block", F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)))
    order = Window.orderBy(F.desc("length"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(
        placed.groupBy("length", "_block")
        .agg(F.sum("_n").alias("_m"))
        .select("length", "_block", F.coalesce(F.sum("_m").over(order), F.lit(0)).alias("_offset"))
    )
    before = Window.partitionBy("length", "_block").orderBy(*rows.columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_rank", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = attach(ranked, offsets, ["length", "_block"]).select(*rows.columns, "_n", (F.col("_offset") + F.col("_rank")).alias("_at"))
    numbers = written_out(ranked, F.col("_at"), "_n", "sequence_id", most)
    return numbers.select(*rows.columns, "sequence_id", F.lit(0).cast("long").alias("offset"))


def pack(docs: DataFrame, path: str | None = None, most: int = MOST, end: int = END) -> DataFrame:
    """The packed sequences of `docs` in one pass without a shuffle: a row for each, with its ids and source document.

    Its sequence_id is unique, and gapless within each partition only.
    """
    return pieces(docs, path, most, end).withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )


def digest(docs: DataFrame, path: str | None = None, most: int = MOST, end: int = END) -> DataFrame:
    """The pieces with a checksum in place of the ids, and gapless sequence_id."""
    return numbered(pieces(docs, path, most, end, with_ids=False))
