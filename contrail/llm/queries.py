"""The registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, htmltext, licenses, mixing, packing, projections, quality, setsketch, sharding, surrogates, syncmers, urlrules, wavelets
from .shared import cut, read


def op1_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = quality.classify(docs, read(spark, sf_dir, "labels"), carry=False)
    return found.select("doc_id", "source", "lang", "evidence", "host_share", "path_share", "probability", "kept")


def op2_entropy_balanced_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(mixing.sized(read(spark, sf_dir, "documents")))
    return mixing.mixed(sizes, mixing.plan(sizes)).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies", "extra", "taken"
    )


def op3_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(read(spark, sf_dir, "documents"))


def op4_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(read(spark, sf_dir, "documents"))


def op6_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op7_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read(spark, sf_dir, "documents"), width=4, threshold=80)


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymize(read(spark, sf_dir, "documents"))
    kinds = F.array_join(F.transform("entities", lambda e: e["kind"]), ",")
    return found.select("doc_id", "text", F.size("entities").alias("n_entities"), kinds.alias("kinds"))


def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op11_wavelet_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelets.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hierarchical_quality": op1_hierarchical_quality,
    "op2_entropy_balanced_mix": op2_entropy_balanced_mix,
    "op3_power_of_two_packing": op3_power_of_two_packing,
    "op4_url_automaton": op4_url_automaton,
    "op5_closed_syncmers": op5_closed_syncmers,
    "op6_sorted_projections": op6_sorted_projections,
    "op7_setsketch_near_dedup": op7_setsketch_near_dedup,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_feistel_sharding": op9_feistel_sharding,
    "op10_crf_main_text": op10_crf_main_text,
    "op11_wavelet_search": op11_wavelet_search,
    "op12_suffix_collocations": op12_suffix_collocations,
    "op13_license_diagonals": op13_license_diagonals,
}

def _reach(edges: str, nodes: str) -> str:
    """SQL for the smallest node that each node reaches over symmetric `edges` (a, b)."""
    return (
        f"reach(n, m) AS (SELECT id, id FROM {nodes} UNION SELECT e.b, r.m FROM reach r JOIN {edges} e ON e.a = r.n), "
        "comp AS (SELECT n AS id, min(m) AS component_id FROM reach GROUP BY n)"
    )


_GLOBS = " OR ".join(
    # a glob over `.host|path` as a pattern; no supplied address has a line break for the bar to be mistaken for
    "regexp_matches(u, '^" + g.replace(".", "\\.").replace("|", "\n").replace("*", ".*").replace("?", ".") + "$', 's')"
    for g in urlrules.BLOCKED
)
_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in urlrules.RULES)

ORACLE: dict[str, str] = {
    "op4_url_automaton": f"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages), r(v, h, q) AS (VALUES {_RULES}),
 f AS (SELECT page_id, first(h || q ORDER BY length(h || q) DESC) AS rule, first(v ORDER BY length(h || q) DESC) AS v FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY 1),
 u AS (SELECT *, '.' || host || chr(10) || path AS u FROM p)
 SELECT u.page_id, host, path, rule, coalesce(v, CASE WHEN {_GLOBS} THEN 'block' ELSE 'allow' END) AS verdict FROM u LEFT JOIN f ON f.page_id = u.page_id""",
    "op6_sorted_projections": f"""WITH RECURSIVE v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 edges AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id AND list_cosine_similarity(a.e, b.e) >= 0.93), {_reach('edges', 'v')}
 SELECT v.id AS vec_id, (SELECT count(*) FROM edges WHERE a = v.id) AS n_links, component_id, v.id = component_id AS kept FROM v JOIN comp ON comp.id = v.id""",
    "op7_setsketch_near_dedup": f"""WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 s AS (SELECT id, unnest(list_distinct(list_transform(range(1, greatest(2, len(w) - 2)), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g FROM w WHERE len(w) > 0),
 n AS (SELECT id, count(*) AS n FROM s GROUP BY 1), i AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
 edges AS (SELECT a, b FROM i JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * k >= 80 * (p.n + q.n - k)), {_reach('edges', 'w')}
 SELECT w.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, w.id = component_id AS kept FROM w JOIN comp ON comp.id = w.id LEFT JOIN n ON n.id = w.id""",
    "op11_wavelet_search": r"""WITH d AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
 s AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
 p AS (SELECT d, doc_id, len(w) AS size, unnest(w) AS term FROM d), tf AS (SELECT d, doc_id, size, term, count(*) AS tf FROM p GROUP BY ALL),
 df AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, n),
 q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
 c AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
 scored AS (SELECT item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * size * n) // total))))::BIGINT AS score FROM c JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL),
 ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
 SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op12_suffix_collocations": r"""WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
 w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM t),
 g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p FROM w, (VALUES (1), (2), (3)) x(k) WHERE len(w) >= k),
 f AS (SELECT lang, k, p, count(*) AS n FROM g GROUP BY 1, 2, 3), total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
 c AS (SELECT lang, k, p, n AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
 longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS p, a AS more FROM c WHERE k = 3),
 kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.p = c.p AND 100 * more >= 50 * a)),
 cuts AS (SELECT c.lang, c.p, a, i, l.n AS l, r.n AS r, ((1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n))::BIGINT AS score FROM kept c, (VALUES (1), (2)) x(i), f l, f r
 WHERE i < c.k AND l.lang = c.lang AND l.p = array_to_string(c.w[1:i], ' ') AND r.lang = c.lang AND r.p = array_to_string(c.w[i + 1:], ' ')),
 best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, i) AS o FROM cuts),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM best WHERE o = 1)
 SELECT ranked.lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000""",
}
