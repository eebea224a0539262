"""The operators' queries with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import gif, language, licenses, mixing, packing, quality, sharding, simhash, suffix, url_rules
from quire.sources.readers import spread, tables

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(tables(spark, sf_dir, name))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.label(table(spark, sf_dir, "documents"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    out = sharding.shard(table(spark, sf_dir, "documents"), SHARDS, size, {"text_crc32": crc})
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.store_texts(table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rule_table(spark, url_rules.RULES)
    return url_rules.judge(table(spark, sf_dir, "pages"), rules, *url_rules.lengths(url_rules.RULES))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("host")


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pack, op2_simhash, op3_language, op4_shards, op5_mix, op6_gif, op7_urls, op8_licenses, op9_quality, op10_suffix)}

OP7 = r"""
WITH parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/'))
SELECT page_id, host, path, r.rhost || r.rpath AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC) = 1
"""

OP9 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
ws AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS k FROM ws WHERE len(w) >= 3),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c >= 2),
rep AS (SELECT doc_id, count(DISTINCT i + x) AS n FROM twice, (VALUES (0), (1), (2)) v(x) GROUP BY doc_id),
stats AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM ws LEFT JOIN rep USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k FROM failed GROUP BY source),
prior AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) > v THEN m * (1 - m) / v - 1 ELSE r END AS weight FROM (SELECT avg(k / n) AS m, var_samp(k / n) AS v, sum(n) AS r FROM hosts)),
rates AS (SELECT source, m, n + weight + 1 AS trials, (k + m * weight) / (n + weight) AS rate FROM hosts, prior),
verdicts AS (SELECT source, rate > 0.8 OR rate > m + sqrt(rate * (1 - rate) / trials) AS host_failed FROM rates)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
FROM failed f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""

OP10 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 99)) AS s, unnest(list_transform(range(0, len(h) // 2 - 99), lambda i: md5(substr(h, 2 * i + 1, 200)))) AS k FROM d WHERE len(h) >= 200),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
runs AS (SELECT doc_id, s, sum(c) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (SELECT doc_id, s, (coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 100, true))::INT AS c FROM later)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) || substr(any_value(h), (2 * max(b) + 1)::BIGINT) AS rest FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op5_mix": mixing.oracle(), "op7_urls": OP7, "op9_quality": OP9, "op10_suffix": OP10}
