"""Digests of ordered tables as trees of hashes, so that no task reads all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import cut, row_numbers

#: Digests that one digest of the next level covers.
WIDTH = 4096


def ordered_digest(rows: DataFrame, order: list[Column], content: Column, width: int = WIDTH) -> str:
    """SHA-256, in hexadecimal digits, of the texts `content` of all rows in their order.

    Rows equal in order are ordered by their own digests. Rows are numbered by ranges; every `width` digests in a row are
    hashed together, then every `width` of these, until one is left, so the digest depends on the rows and their order
    and not on how they are dealt out, and a task holds `width` digests of a block. The digest of no rows is that of an empty text.
    """
    each = rows.select(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.sha2(content, 256).alias("digest"))
    by = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]
    level = row_numbers(each, [*by, F.col("digest").asc_nulls_first()], "at").select("at", "digest")
    n = level.count()
    while n > 1:
        block = level.groupBy(F.floor(F.col("at") / width).alias("at"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]), "")
        level = cut(block.agg(F.sha2(joined, 256).alias("digest")))
        n = -(-n // width)
    found = level.first()
    return found["digest"] if found else rows.sparkSession.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
