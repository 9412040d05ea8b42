"""The queries that apply the operators to their whole tables, and the SQL that some of them are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lines, links, quality, secrets, warc
from .common import Scratch
from .decontaminate import leaks
from .html import extract
from .minhash import near_duplicates
from .mixing import mix
from .shards import shard_documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "archives").path("pages")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path)


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality_scores(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "language", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


#: The query's table of blocked seeds, an input like the rules: first labels of hosts, but for www, blog and m.
BLOCKED_LABELS = ("spam-farm", "cheap-pills", "casino-win", "free-bets")
_BLOCKED_HOST = r"^((www|blog|m)\.)?(" + "|".join(BLOCKED_LABELS) + r")\."


def op7_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(links.split_url(F.col("url"))[0].alias("host")).where(F.col("host").rlike(_BLOCKED_HOST)).distinct()
    judged = links.judge(pages, seeds=hosts.withColumn("kind", F.lit("d")))
    return judged.withColumns({c: F.round(c, 9) for c in ("trust", "distrust")})


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard, and what a reader finds there."""
    rows = shard_documents(table(spark, sf_dir, "documents"))[1]
    return rows.select("doc_id", "source", F.length("text").alias("n_points"), F.md5("text").alias("text_md5"), "shard")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_lines": op3_lines,
    "op4_minhash": op4_minhash,
    "op5_quality": op5_quality,
    "op6_html": op6_html,
    "op7_links": op7_links,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_secrets": op10_secrets,
}

#: Words, as the operators take them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first,
             array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT, 1)), '')), '') AS b32 FROM p)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM d""",
    "op3_lines": lines.oracle_sql(),
    "op5_quality": quality.oracle_sql(),
    "op7_links": links.oracle_sql(seed_hosts=f"SELECT host FROM hosts WHERE regexp_matches(host, '{_BLOCKED_HOST}')"),
    "op10_secrets": secrets.oracle_sql(),
    "op4_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
texts AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
flat AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM texts),
pairs AS (SELECT a.rep AS a, b.rep AS b FROM flat a JOIN flat b ON a.x = b.x AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(node, low) AS (SELECT rep, rep FROM texts UNION SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node),
roots AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(r.low, d.doc_id) AS component_id, d.doc_id = coalesce(r.low, d.doc_id) AS kept
FROM sets d LEFT JOIN texts t ON list_sort(d.s) = t.s LEFT JOIN roots r ON r.node = t.rep""",
    "op8_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM sources),
limits AS (SELECT *, 3.0::DOUBLE * source_size AS lim, 3.0::DOUBLE * source_size / weight AS ratio FROM weighted),
shares AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(lim) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS share
  FROM limits WINDOW b AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(share, ratio) AS level FROM shares WHERE share <= ratio),
goals AS (
  SELECT source, source_size, least(lim, level * weight) AS target, CAST(round(least(lim, level * weight)) AS BIGINT) AS budget
  FROM shares, level),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.budget, CASE WHEN g.source_size > 0 THEN g.budget // g.source_size ELSE 0 END AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, round(target, 3) AS target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed""",
}
