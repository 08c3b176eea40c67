"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.llm import decontaminate, divergence, licenses, lm, packing, periodic, pii, quality, sharding, simhash, substring, token_counts, versions
from orderscope.llm.frames import read


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_fingerprints(read(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_summary(licenses.scan(read(spark, sf_dir, "documents")))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.pseudo_likelihood(read(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                        F.size("near_items").cast("bigint").alias("n_near_items"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.token_packed(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(read(spark, sf_dir, "documents"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(read(spark, sf_dir, "documents"), edit=periodic.looped)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": op1_substring,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_versions": op4_versions,
    "op5_licenses": op5_licenses,
    "op6_lm": op6_lm,
    "op7_sharding": op7_sharding,
    "op8_decontaminate": op8_decontaminate,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_pii": op11_pii,
    "op12_periodic": op12_periodic,
    "op13_divergence": op13_divergence,
}

# DuckDB statements where SQL can express the whole query.
ORACLE: dict[str, str] = {"op13_divergence": """
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), held AS (
  SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(h.n), 0) AS HUGEINT) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN held h ON g.lang = h.lang AND g.source = h.source GROUP BY ALL
), chances AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(h.n, 0) + 1)) // CAST(g.n + l.v AS HUGEINT) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // CAST(l.n + l.v AS HUGEINT) AS q
  FROM groups g JOIN langs l ON g.lang = l.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM chances WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM rows_
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 200"""}
