"""Document fingerprints from closed syncmers, by SQL functions only.

A text is read as tokens; every token has a hash. A k-mer of tokens is a closed syncmer if the least of its inner
s-mers' hashes stands first or last in it. That is decided by the k-mer alone, so equal passages give equal anchors
wherever they stand, and an edit touches the anchors near it only. Tokens end where their own characters say so, never at a
count, so that this holds within long runs without spaces too. Of any K - S + 1 k-mers in a row one is an anchor.

Anchors are (position, hash). The fingerprint holds all of a text in order, each as 32 bits of its hash and the step from
the one before. `likeness` is the Jaccard index of two anchor sets, `aligned` that of the anchors with their positions, and
`passages` finds shared runs of two documents at whatever offset.

Nulls: a null text is empty; an empty text has no anchors and an empty fingerprint; two empty ones are alike (1), an
empty and another are not (0). A text without any closed syncmer, such as one of fewer than K tokens, has one anchor, its whole
token sequence. Null ids come first in the order; equal ids are ordered by their texts' hashes, and rows equal in both are
next to each other. Very long texts are read whole. An empty table gives an empty result. Other columns pass through
`fingerprints`, but for those that bear the name of a column of the result; the rest does not read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .shared import cut, without

#: Tokens of a k-mer and of its inner s-mers; K - S is at most 15.
K = 8
S = 2
#: Scripts without spaces, of which each character is a token, by their blocks: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
_SINGLE = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{2FA1F}"
#: Characters that end a token within a run: rare letters, digits and signs that join.
_LAST = r"jqxzJQXZ0-9+/=_\-"
TOKEN = rf"[^\s{_SINGLE}{_LAST}]++[{_LAST}]?+|[{_SINGLE}{_LAST}]"
#: Ranges of ids, each ordered by one task, for each shuffle partition.
RANGES = 4
#: Bounds of ranges that are looked through at a time.
STRIDE = 256


def tokens(text: Column) -> Column:
    """Hashes of the tokens of a text, in order."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.xxhash64(t))


def let(value: Column, use) -> Column:
    """use(value) with `value` evaluated once: a lambda's argument is held, a repeated expression is not."""
    return F.element_at(F.transform(F.array(value), use), 1)


def anchors(hashes: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of an array of token hashes: array of (pos, hash), positions in tokens from 0."""
    last = k - s

    def of(h: Column) -> Column:
        n = F.size(h)
        smers = F.transform(
            F.slice(h, 1, F.greatest(n - (s - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, s)]),
        )

        def from_smers(m: Column) -> Column:
            # m[i] hashes the s tokens from i; the k-mer from i has the s-mers i .. i + last
            def keep(x: Column, i: Column) -> Column:
                inner = [F.get(m, i + j) for j in range(1, last)]
                edge = F.least(x, F.get(m, i + last)) <= F.least(*inner, F.lit(2**63 - 1))
                mer = F.xxhash64(*[F.get(h, i + j) for j in range(k)])
                return F.when((i < n - (k - 1)) & edge, F.struct(i.alias("pos"), mer.alias("hash")))

            return F.filter(F.transform(m, keep), lambda x: x.isNotNull())

        whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash")))
        some = F.when(n >= k, let(smers, from_smers)).otherwise(F.filter(whole, lambda _: F.lit(False)))
        return let(some, lambda x: F.when((F.size(x) == 0) & (n > 0), whole).otherwise(x))

    return let(hashes, of)


def marks(found: Column) -> Column:
    """32 bits of each anchor's hash."""
    return F.transform(found, lambda a: a["hash"].bitwiseAND(F.lit(0xFFFFFFFF)))


def as_text(found: Column) -> Column:
    """Anchors in order as hexadecimal digits, nine for each: its mark and the step from the position before."""
    step = lambda a, i: a["pos"] - F.coalesce(F.get(found, i - 1)["pos"], F.lit(0))
    one = lambda a, i: F.concat(F.lpad(F.hex(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"), F.hex(step(a, i)))
    return F.lower(F.array_join(F.transform(found, one), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays as sets, 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def placed(found: Column) -> Column:
    """A hash of each anchor and its position."""
    return F.transform(found, lambda a: F.xxhash64(a["pos"], a["hash"]))


def aligned(a: Column, b: Column) -> Column:
    """Jaccard index of two texts' anchors with their positions."""
    return likeness(placed(a), placed(b))


def passages(pairs: DataFrame, least: int = 2) -> DataFrame:
    """Shared runs of the documents of `pairs` (pair, a, b: anchors): rows (pair, shift, start, end, anchors), the
    anchors with equal marks whose positions differ by `shift`, from `start` to `end` in a, `least` of them at least.

    Anchors meet by pair and mark; where a mark is repeated in both, its n-th place meets the n-th, so that a repeated
    line gives no product. No pair is held in a task, as its rows are dealt by mark.
    """

    def side(name: str) -> DataFrame:
        rows = pairs.select("pair", F.explode(name).alias("x")).select("pair", F.col("x.hash").alias("hash"), F.col("x.pos").alias(name))
        return rows.withColumn("nth", F.row_number().over(Window.partitionBy("pair", "hash").orderBy(name)))

    met = side("a").join(side("b"), ["pair", "hash", "nth"]).groupBy("pair", (F.col("b") - F.col("a")).alias("shift"))
    return met.agg(F.min("a").alias("start"), F.max("a").alias("end"), F.count("*").alias("anchors")).where(F.col("anchors") >= least)


def fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` with `anchors` and `fingerprint`."""
    hashed = without(docs, "anchors", "fingerprint", "_t").withColumn("_t", tokens(F.col("text")))
    return hashed.withColumn("anchors", anchors(F.col("_t"))).withColumn("fingerprint", as_text(F.col("anchors"))).drop("_t")


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are at most `value`: first among every STRIDE-th, then between two of them."""
    of = lambda some: F.array(*map(F.lit, some)).cast("array<bigint>")
    before = F.size(F.filter(of(bounds[STRIDE - 1 :: STRIDE]), lambda b: b <= value)) * STRIDE
    return before + F.size(F.filter(F.slice(of(bounds), before + 1, STRIDE), lambda b: b <= value))


def followed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, h, part, guest, next_text): each text with that of the next document by ascending id, the last
    with the first.

    Ids are cut into ranges at approximate quantiles, so that no task orders them all; an id (or null) of so many rows that
    several quantiles fall on it is cut further by its texts' hashes. The first document of each part also goes to the
    part before, and the first of all to the last, where it only serves as the next one. Only the bounds come to the
    driver, as many as there are ranges.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.shiftrightunsigned(F.xxhash64(text), 1).alias("h"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.select(F.percentile_approx("doc_id", shares, 10 * ranges).alias("q"), F.count_if(F.col("doc_id").isNull()).alias("n"), F.count("*").alias("all")).first()
    found = cuts["q"] or []
    bounds = sorted(set(found))
    often = {b: found.count(b) for b in bounds if found.count(b) > 1}
    pieces = F.lit(1 + ranges * cuts["n"] // max(1, cuts["all"]))  # of the rows without an id
    if often:
        pieces = F.when(F.col("doc_id").isNull(), pieces).otherwise(F.element_at(F.create_map(*[F.lit(x) for pair in often.items() for x in pair]), F.col("doc_id")))
    else:
        pieces = F.when(F.col("doc_id").isNull(), pieces)
    # an id that is cut further is the least of its range, so the rest of the range comes after its pieces
    piece = F.coalesce(F.floor(F.col("h") / F.lit(2.0**63) * pieces), F.lit(ranges + 1))
    range_ = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + _below(bounds, F.col("doc_id")))
    rows = rows.withColumn("part", range_ * F.lit(ranges + 2).cast("long") + piece)
    # ids compare null first: (is not null, id)
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.col("h").alias("h"))
    order = Window.orderBy("part")
    firsts = rows.groupBy("part").agg(F.min(rank).alias("first"))
    before = F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy()))
    firsts = cut(firsts.select("part", "first", before.alias("before")))
    # a few rows for each range, so the broadcast is bounded
    known = rows.join(F.broadcast(firsts), "part")
    here, there = (F.struct(F.col(c).alias("part"), F.lit(g).alias("guest")) for c, g in (("part", 0), ("before", 1)))
    places = F.when(rank == F.col("first"), F.array(here, there)).otherwise(F.array(here))
    met = known.select("doc_id", "text", "h", F.explode(places).alias("at")).select("doc_id", "text", "h", "at.*")
    return met.withColumn("next_text", F.lead("text").over(_within()))


def _within() -> WindowSpec:
    return Window.partitionBy("part").orderBy("guest", F.col("doc_id").asc_nulls_first(), "h")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and the likenesses: the rows of the query op5."""
    pairs = followed(docs).withColumn("_own", anchors(tokens(F.col("text"))))
    own = pairs.withColumn("_next", F.lead(marks(F.col("_own"))).over(_within()))
    n = F.char_length("text")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - moved), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), moved))
    done = own.where("guest = 0").withColumn("edited", edited)
    done = done.withColumn("_edited", anchors(tokens(F.col("edited"))))
    return done.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(marks(F.col("_own")), marks(F.col("_edited"))).alias("near_edited"),
        likeness(marks(F.col("_own")), F.col("_next")).alias("near_next"),
        aligned(F.col("_own"), F.col("_edited")).alias("aligned_edited"),
    )
