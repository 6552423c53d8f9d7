"""Quality classifier with hierarchical empirical Bayes: document evidence, shrunk host and path posteriors.

A logistic model over surface statistics of the whole text gives each document its evidence, the log likelihood ratio of
good to bad. Grouped aggregation then counts expected good documents by path and host. The share of a host is a beta
posterior around the global share, the share of a path one around its host's, each prior as strong as the spread between
hosts (paths) says, by moments: a site with few documents stays near the prior, a large one shows its own share. The
posterior log odds of a document are its evidence plus the log odds of its path.

Texts are read once: their evidence is kept in a checkpoint, of which both the sites and the result are made.

Nulls: a null or blank text has no evidence of quality and is rejected with probability 0; null hosts and paths are
sites of their own; labels without a matching document, null labels and labels other than 0 and 1 are ignored, and a
document labelled twice counts twice. Of labelled rows that repeat an id, the one whose text has the least hash is fitted.
Without labels of both kinds no document can be told apart: every document that is not blank gets even odds and is kept.
Very long texts are read whole, in time in proportion to their length. Empty tables give empty results. Other columns pass
through, but for those that bear the name of a column of the result, which gives way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import attach, cut, lean, without
from .urlrules import host_of, path_of

#: The model is fitted on at most so many labelled documents, those with the least hashes of their ids.
FIT_ROWS = 20_000
#: A document is kept if its posterior is at least this.
KEEP = 0.5
#: Unless the caller says otherwise, the site's log odds count at most so much either way, so that a site alone never
#: condemns a good document.
SITE_LIMIT = 2.0
#: Bounds of a prior's strength, in documents.
STRENGTH = (10.0, 10_000.0)

_MARKS = {name: [ord(c) for c in chars] for name, chars in {"symbol": "#$%&*@^~=+", "bang": "!?", "bar": "|\\/", "bracket": "<>{}[]()", "under": "_", "stop": ".,;:"}.items()}


def statistics(text: str) -> list[float]:
    """Surface statistics of a whole text, in one pass over its bytes and one over its words."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(1, len(raw))
    count = np.bincount(raw, minlength=256)
    words = text.split()
    w = max(1, len(words))
    lines = text.split("\n")
    often = Counter(words)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    shares = [count[at].sum() / n for at in _MARKS.values()]
    shares += [count[48:58].sum() / n, upper / max(1, upper + lower), count[128:].sum() / n, (count[:9].sum() + count[14:32].sum()) / n]
    return [
        *(np.log1p(200 * x) for x in shares),
        min(30.0, len(raw) / w),
        np.log1p(len(words)),
        len(often) / w**0.8,
        max(often.values(), default=0) / w,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(lines) / w * 10),
    ]


@dataclass(frozen=True)
class Model:
    """A logistic model over standardised statistics; `base` is the log odds of its labelled documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Log likelihood ratios of good to bad."""
        x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(self.mean))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(x @ self.weights[:-1] + self.weights[-1] - self.base, -30, 30)


def fit(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Model:
    """A ridge logistic regression by Newton steps; each row counts `times`."""
    mean = np.average(x, axis=0, weights=times)
    scale = np.maximum(np.sqrt(np.average((x - mean) ** 2, axis=0, weights=times)), 1e-6)
    z = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z @ w))
        h = (z * (times * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(h, z.T @ (times * (y - p)) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    share = np.average(y, weights=times)
    return Model(mean, scale, w, float(np.log(share / (1 - share))))


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model | None:
    """The model of at most `most` labelled documents, or None without both labels. Only statistics reach the driver."""

    @F.pandas_udf("array<double>")
    def stats(lots: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lot in lots:
            yield pd.Series([statistics(t) for t in lot])

    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id", "quality").agg(F.count("*").alias("times"))
    chosen = cut(known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most))
    # at most `most` rows, so the broadcast is bounded
    rows = docs.select("doc_id", "text").where("length(trim(text)) > 0").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "quality", "times", F.xxhash64("text").alias("h"), stats("text").alias("x"))
    found = rows.groupBy("doc_id", "quality").agg(F.min(F.struct("h", "x", "times")).alias("r")).orderBy("doc_id", "quality").collect()
    y = np.array([r["quality"] for r in found], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return None
    return fit(np.array([r["r"]["x"] for r in found]), y, np.array([r["r"]["times"] for r in found], dtype=float))


def with_evidence(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with `evidence`, null where the text is null or blank."""

    @F.pandas_udf("double")
    def evidence(lots: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lot in lots:
            out = np.full(len(lot), np.nan)
            full = [i for i, t in enumerate(lot) if t is not None and t.strip()]
            for i in range(0, len(full), 256):
                at = full[i : i + 256]
                out[at] = 0.0 if model is None else model.evidence([lot.iloc[k] for k in at])
            yield pd.Series(out)

    found = docs.withColumn("evidence", evidence("text"))
    return found.withColumn("evidence", F.when(~F.isnan("evidence"), F.round("evidence", 6)))


def _strength(mean: str, groups: DataFrame) -> Column:
    """Moments: how many documents a prior is worth, from the spread of group shares around `mean` beyond chance."""
    n, share, m = F.col("n"), F.col("good") / F.col("n"), F.col(mean)
    chance = m * (1 - m)
    # expected: sum n (share - m)^2 = chance * groups * (1 - rho) + chance * rho * sum n
    excess = F.sum(n * (share - m) * (share - m)) - F.sum(chance)
    rho = excess / F.greatest(F.sum(n * chance) - F.sum(chance), F.lit(1e-9))
    rho = F.greatest(F.lit(1e-6), F.least(F.lit(0.999999), rho))
    return F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), 1 / rho - 1))


def sites(scored: DataFrame, base: float) -> DataFrame:
    """Rows (host, path, documents, host_share, path_share): shrunk shares of good documents.

    `scored` has host, path and evidence. Expected counts are summed in millionths as whole numbers, so that the sums
    do not depend on their order.
    """
    chance = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(base))))
    good = F.sum(F.coalesce(F.round(chance * 1_000_000).cast("long"), F.lit(0)))
    paths = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), good.alias("g")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    hosts = cut(hosts.withColumn("good", F.col("g") / 1_000_000))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()
    share = min(0.999, max(0.001, (total["g"] or 0) / 1e6 / max(1, total["n"] or 0)))
    s = hosts.withColumn("m", F.lit(share)).agg(_strength("m", hosts).alias("s")).first()["s"] or STRENGTH[0]
    hosts = hosts.select("host", ((F.col("good") + s * share) / (F.col("n") + s)).alias("host_share"))
    joined = cut(attach(paths.withColumn("good", F.col("g") / 1_000_000), cut(hosts), ["host"]))
    t = joined.agg(_strength("host_share", joined).alias("s")).first()["s"] or STRENGTH[0]
    return cut(
        joined.select(
            "host",
            "path",
            F.col("n").alias("documents"),
            "host_share",
            ((F.col("good") + t * F.col("host_share")) / (F.col("n") + t)).alias("path_share"),
        )
    )


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", url: str | None = None,
    keep: float = KEEP, site_limit: float = SITE_LIMIT, carry: bool = True,
) -> DataFrame:
    """`docs` with evidence, host_share, path_share, probability and kept.

    Hosts and paths are columns of `docs`; with `url`, a column of addresses, the host is the address's, and the path its
    host with the first step of its path. Without `carry` the text is left out, so that no text is written or shuffled.
    The table of sites is looked up by broadcast while it is small, else by salted keys.
    """
    docs = lean(docs)
    made = ("evidence", "host_share", "path_share", "probability", "kept")
    docs = without(docs, *(m for m in (*made, "documents", "_host", "_path") if m not in (host, path, url)))
    names = [c for c in docs.columns if carry or c != "text"]
    model = train(docs, labels)
    base = model.base if model else 0.0
    at = F.col(url) if url else None
    site = (F.col(host), F.col(path)) if at is None else (host_of(at), F.regexp_extract(path_of(at), "^/[^/]*", 0))
    scored = cut(with_evidence(docs, model).select(*names, site[0].alias("_host"), site[1].alias("_path"), "evidence"))
    table = sites(scored.select(F.col("_host").alias("host"), F.col("_path").alias("path"), "evidence"), base)
    table = table.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "host_share", "path_share")
    found = attach(scored, table, ["_host", "_path"])
    share = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("path_share")))
    odds = F.greatest(F.lit(-site_limit), F.least(F.lit(site_limit), F.log(share / (1 - share))))
    probability = F.coalesce(1 / (1 + F.exp(-(F.col("evidence") + odds))), F.lit(0.0))
    if model is None:
        probability = F.when(F.col("evidence").isNotNull(), F.lit(0.5)).otherwise(0.0)
    return found.withColumn("probability", probability).select(
        *[found[c] for c in names],
        "evidence",
        "host_share",
        "path_share",
        "probability",
        (F.col("probability") >= keep).alias("kept"),
    )
