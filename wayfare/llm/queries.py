"""The thin contract queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import context_tree, html_text, metric_tree, minhash, mixing, packing, quality, suffix_dedup, toxicity, urls
from .common import crc_mod, read_table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.search(read_table(spark, sf_dir, "embeddings"), lambda vec_id: F.pmod(vec_id, F.lit(50)) == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), k=2)
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in counts], "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_topk": op3_topk,
    "op4_toxicity": op4_toxicity,
    "op5_html": op5_html,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_context_tree": op7_context_tree,
    "op8_url_filter": op8_url_filter,
    "op9_minhash": op9_minhash,
    "op10_quality_rules": op10_quality_rules,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS BIGINT) AS weight FROM s
), r AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS level_at FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY level_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / (sum(weight) OVER (ORDER BY level_at, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS try_level
  FROM r
), t AS (
  SELECT source, source_size, least(cap, weight * (SELECT coalesce(arg_min(try_level, (level_at, source)), 0) FROM l WHERE try_level <= level_at)) AS target FROM l
), n AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS lim, CAST(ceil(floor(target) / 1024.0::DOUBLE) AS BIGINT) AS need, coalesce('=' || source, 'null') AS sk FROM t
), h AS (
  SELECT sk, need, sum(need) OVER (ORDER BY sk)::DOUBLE / sum(need) OVER ()::DOUBLE AS hi, (sum(need) OVER (ORDER BY sk) - need)::DOUBLE / sum(need) OVER ()::DOUBLE AS lo FROM n WHERE need > 0
), x AS (
  SELECT i AS slot, i * 0.6180339887498949::DOUBLE - floor(i * 0.6180339887498949::DOUBLE) AS x FROM (SELECT unnest(range(0, CAST((SELECT coalesce(sum(need), 0) FROM n) AS BIGINT))) AS i)
), hit AS (
  SELECT slot, sk, need, row_number() OVER (PARTITION BY sk ORDER BY slot) - 1 AS rk FROM x JOIN h ON x >= lo AND x < hi
), plan AS (
  SELECT sk, rk, slot FROM hit WHERE rk < need
  UNION ALL
  SELECT sk, rk, (SELECT sum(need) FROM n) + rk FROM (SELECT h.sk, unnest(range((SELECT count(*) FROM hit WHERE hit.sk = h.sk), h.need)) AS rk FROM h)
), p AS (
  SELECT d.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS BIGINT) AS a, coalesce('=' || source, 'null') AS sk FROM d
), e AS (
  SELECT p.doc_id, p.size, p.a, p.sk, n.source_size, n.target, n.lim, u.epoch, CAST(p.a + u.epoch * n.source_size AS BIGINT) AS f FROM p JOIN n USING (sk), (VALUES (0), (1)) u(epoch)
), g AS (
  SELECT doc_id, size, a, sk, min(slot) AS slot FROM plan JOIN (
    SELECT doc_id, size, a, sk, unnest(range(f // 1024, (least(f + size, lim) - 1) // 1024 + 1)) AS rk FROM e WHERE size > 0 AND f < lim) USING (sk, rk) GROUP BY ALL
)
SELECT e.doc_id, e.size, e.source_size, e.target, CAST(sum(greatest(0, least(f + e.size, lim) - f)) AS BIGINT) AS taken, CAST(any_value(g.slot) AS BIGINT) AS slot
FROM e LEFT JOIN g ON g.doc_id IS NOT DISTINCT FROM e.doc_id AND g.a = e.a AND g.sk = e.sk AND g.size = e.size
GROUP BY e.doc_id, e.size, e.a, e.sk, e.source_size, e.target
"""


def _quality_sql() -> str:
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(quality.STOP_WORDS)))
    value = {
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "shouts_per_word": "n_shouts / nullif(n_words, 0)",
        "stop_word_ratio": "n_stop / nullif(n_words, 0)",
        "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "repeat_word_ratio": "n_repeat_words / nullif(n_words, 0)",
    }
    tests = []
    for rule in quality.RULES:
        v = f"coalesce({value[rule.feature]}, 0)"
        tests += [f"{v} >= {rule.least}"] * (rule.least is not None) + [f"{v} <= {rule.most}"] * (rule.most is not None)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), pos AS (
  SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3
), tri AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM pos
), cover AS (
  SELECT rid, count(DISTINCT j) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE n > 1) GROUP BY rid
), c AS (
  SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    (length(t) - length(replace(t, '!!', ''))) / 2.0::DOUBLE AS n_shouts,
    len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), f AS (
  SELECT c.*, len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM c LEFT JOIN cover USING (rid)
), g AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(tests)} AS kept
FROM g
"""


_MINHASH = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d
), n AS (
  SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, md5(array_to_string(list_sort(g), chr(10))) AS h FROM s
), c AS (
  SELECT h, min(doc_id) AS rep, min(n_shingles) AS n FROM n WHERE n_shingles > 0 GROUP BY h
), x AS (
  SELECT c.rep, c.n, unnest(s.g) AS e FROM c JOIN s ON s.doc_id = c.rep
), rare AS (
  SELECT e, count(*) AS df FROM x GROUP BY e
), ranked AS (
  SELECT x.rep, x.n, x.e, row_number() OVER (PARTITION BY x.rep ORDER BY r.df, x.e) AS k FROM x JOIN rare r ON r.e = x.e
), prefix AS (
  SELECT rep, n, e FROM ranked WHERE k <= n - ceil(0.8 * n) + 1
), cand AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb FROM prefix a JOIN prefix b ON a.e = b.e AND a.rep < b.rep
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), both_sides AS (
  SELECT a, b, any_value(na) AS na, any_value(nb) AS nb, count(*) AS k FROM cand JOIN x p ON p.rep = a JOIN x q ON q.rep = b AND q.e = p.e GROUP BY a, b
), links AS (
  SELECT a, b FROM both_sides WHERE 100 * k >= 80 * (na + nb - k)
), sym AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), walk AS (
  SELECT rep AS a, rep AS b FROM c UNION SELECT w.a, s.b FROM walk w JOIN sym s ON s.a = w.b
), comp AS (
  SELECT a AS rep, min(b) AS component FROM walk GROUP BY a
)
SELECT n.doc_id, n.n_shingles, coalesce(comp.component, n.doc_id) AS component_id, n.doc_id = coalesce(comp.component, n.doc_id) AS kept
FROM n LEFT JOIN c ON c.h = n.h AND n.n_shingles > 0 LEFT JOIN comp ON comp.rep = c.rep
"""


_TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


_REPEATS = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT rid, id, s, hex(b[s : s + 49]) AS k FROM (SELECT rid, id, b, unnest(range(1, octet_length(b) - 48)) AS s FROM d WHERE octet_length(b) >= 50)
), f AS (
  SELECT rid, s FROM (SELECT rid, s, id, min(id) OVER (PARTITION BY k) AS least FROM w) WHERE id > least
), g AS (
  SELECT rid, s, sum(CASE WHEN before IS NULL OR s > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY s) AS grp FROM (SELECT rid, s, lag(s) OVER (PARTITION BY rid ORDER BY s) AS before FROM f)
), r AS (
  SELECT rid, min(s) AS a, max(s) + 50 AS z FROM g GROUP BY rid, grp
), n AS (
  SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed FROM r GROUP BY rid
), edges AS (
  SELECT rid, z AS a FROM r UNION ALL SELECT rid, 1 FROM d
), kept AS (
  SELECT e.rid, e.a, coalesce((SELECT min(r.a) FROM r WHERE r.rid = e.rid AND r.a >= e.a), octet_length(d.b) + 1) AS z FROM edges e JOIN d USING (rid)
), t AS (
  SELECT k.rid, string_agg(CASE WHEN k.z > k.a THEN hex(d.b[k.a : k.z - 1]) ELSE '' END, '' ORDER BY k.a) AS h FROM kept k JOIN d USING (rid) GROUP BY k.rid
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d LEFT JOIN n USING (rid) JOIN t USING (rid)
"""


ORACLES: dict[str, str] = {"op6_suffix_dedup": _REPEATS, "op1_mixing": _MIX, "op3_topk": _TOPK, "op9_minhash": _MINHASH, "op10_quality_rules": _quality_sql()}
