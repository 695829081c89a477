"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, filter_audit, hyperminhash, license_scan, mixing, mlm_scoring, outliers, seed_extend, suffix_index, token_counts, toxicity, wrapper
from .tables import documents


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mlm_scoring.pseudo_likelihood(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), items).drop("tag")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted", "flagged")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.cut(documents(spark, sf_dir))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outliers.quality(documents(spark, sf_dir))
    return found.select("doc_id", *outliers.COUNTS, "base_failed", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seed_extend.cut(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("places")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_html_extraction": op4_html_extraction,
    "op5_mix_sources": op5_mix_sources,
    "op6_token_counts": op6_token_counts,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_license_scan": op13_license_scan,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"


def _shingles(table: str, key: str) -> str:
    """Distinct (key, g): 5-word shingles, or the whole sequence of fewer words."""
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM (SELECT {key}, {_WORDS.format(_LOWER)} AS w FROM {table})"""


ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": f"""
WITH i AS ({_shingles("benchmark", "item_id")}), d AS ({_shingles("documents", "doc_id")}),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY 1)
SELECT doc_id, item_id, any_value(n) AS n_item_shingles, count(*) AS n_shared
FROM i JOIN d USING (g) JOIN n USING (item_id) GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * any_value(n)""",
    "op7_minhash_dedup": f"""
WITH RECURSIVE s AS MATERIALIZED ({_shingles("documents", "doc_id")}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS m FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, m AS component_id, doc_id = m AS kept
FROM documents JOIN m ON doc_id = x LEFT JOIN n USING (doc_id)""",
    "op8_suffix_dedup": """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS g FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM h)),
f AS (SELECT g, min((doc_id, i)) AS p FROM w GROUP BY 1),
b AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS o FROM w JOIN f USING (g) WHERE (doc_id, i) > p),
k AS (SELECT doc_id, i, sum(CASE WHEN o IS NULL OR i > o + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS z FROM k GROUP BY 1, 2),
g AS (SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(z) AS z FROM s GROUP BY 1),
t AS (SELECT doc_id, a, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM s),
q AS (SELECT doc_id, string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS x FROM t JOIN h USING (doc_id) GROUP BY 1)
SELECT h.doc_id, CAST(len(h.x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN g.z IS NULL THEN h.x ELSE coalesce(q.x, '') || substr(h.x, 2 * g.z + 1) END)) AS kept_sha256
FROM h LEFT JOIN g USING (doc_id) LEFT JOIN q USING (doc_id)""",
    "op10_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
n AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS d FROM n GROUP BY 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM n JOIN f USING (g) WHERE d < doc_id),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM w),
k AS (SELECT p.doc_id, string_agg(x, ' ' ORDER BY p.j) FILTER (c.j IS NULL) AS kept, count(c.j) AS n_removed
  FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.j = c.j GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copied FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN copied THEN 16 ELSE 0 END AS m FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS g, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x FROM labels GROUP BY 1),
c AS (SELECT part, m, count(*) AS n, coalesce(sum(g), 0) AS g, coalesce(sum(x), 0) AS x FROM m LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
f AS (SELECT unnest([1, 2, 4, 8, 16]) AS b, unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS s FROM f a, f b, f c, f d, f e WHERE a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, step, s[step] AS b, coalesce(list_sum(s[1:step-1]), 0)::INTEGER AS p FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, b, sum(CASE WHEN m & (p | b) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN m & b > 0 AND m & p = 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN m & b > 0 AND m & p > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN m = b THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN m & b > 0 AND m & p = 0 THEN g ELSE 0 END) AS good_lost,
  sum(CASE WHEN m & b > 0 AND m & p = 0 THEN x ELSE 0 END) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley FROM r""",
    "op12_source_divergence": rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT lang, term FROM (SELECT DISTINCT k, lang, unnest(w) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3),
o AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
s AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN o USING (lang, source, term)),
p AS (SELECT lang, source, term, n, CAST(1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS BIGINT) AS p FROM s JOIN v USING (lang)),
a AS (SELECT lang, term, sum(n) AS n FROM s GROUP BY ALL),
q AS (SELECT lang, term, CAST(1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS BIGINT) AS q FROM a JOIN v USING (lang)),
t AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
c AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (SELECT * FROM t UNION ALL SELECT x.lang, x.source, 'pair', y.source, CAST(coalesce(value, 0) AS BIGINT)
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN c ON c.lang = x.lang AND c.source = x.source AND c.item = y.source),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200""",
}
