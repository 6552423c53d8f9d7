"""Place names in running text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}0-9]+"), lambda w: w != "")


def spans(texts: DataFrame, places: DataFrame, id_: str, tokens: str, most: int = 3, least_chars: int = 4) -> DataFrame:
    """Rows (id_, start, end, and the columns of `places`): names found in token arrays, the longest at each place first,
    none overlapping another.

    `places` has `key`, words joined by spaces, once each. Runs of up to `most` tokens meet the keys by an equi-join. At
    each start the longest name counts; a name is taken if it begins where the one taken before it has ended, or later,
    which one pass over the text's own names decides.
    """
    # each token with those after it, so that a row holds its runs and never the whole text
    after = [F.slice(tokens, n + 1, F.size(tokens)).alias(f"_{n}") for n in range(most)]
    at = texts.select(id_, F.posexplode(F.arrays_zip(*after)).alias("start", "_w"))
    words_ = [F.col(f"_w._{n}") for n in range(most)]
    runs = F.array(*[F.when(words_[n].isNotNull(), F.concat_ws(" ", *words_[: n + 1])) for n in range(most)])
    grams = at.select(id_, "start", F.posexplode(runs).alias("_n", "key")).where(F.length("key") >= least_chars)
    found = grams.join(places, "key").withColumn("end", F.col("start") + F.col("_n") + 1)
    longest = F.row_number().over(Window.partitionBy(id_, "start").orderBy(F.desc("end")))
    found = found.withColumn("_r", longest).where("_r = 1").drop("_r", "_n")
    ends = found.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_all"))

    def take(state: Column, x: Column) -> Column:
        free = x["start"] >= state["end"]
        return F.struct(F.when(free, x["end"]).otherwise(state["end"]).alias("end"), F.when(free, F.concat(state["starts"], F.array(x["start"]))).otherwise(state["starts"]).alias("starts"))

    begin = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
    taken = ends.select(id_, F.explode(F.aggregate("_all", begin, take, lambda s: s["starts"])).alias("start"))
    return found.join(taken, [id_, "start"])


def scan(found: DataFrame, id_: str, name: str, limit: int = 5) -> DataFrame:
    """Rows (id_, names): the first `limit` distinct names of each text in the order of their first place."""
    first = found.groupBy(id_, name).agg(F.min("start").alias("_s"))
    ranked = first.withColumn("_r", F.row_number().over(Window.partitionBy(id_).orderBy("_s"))).where(F.col("_r") <= limit)
    return ranked.groupBy(id_).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", name))), lambda x: x[name]).alias("names"))
