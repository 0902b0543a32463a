"""Query op4_url_reputation: a verdict for every page's url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .url_reputation import judged


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict over all pages."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = """
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
outcome AS (
    SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, regexp_extract(host, '([^.]*\\.)?[^.]*$', 0) AS domain, split_part(host, '.', -1) AS suffix
    FROM parsed LEFT JOIN outcome USING (page_id) GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT sum(bad) / sum(n) FROM hosts) AS prior FROM domains GROUP BY suffix),
m0 AS (SELECT 1 / least(0.5, greatest(0.001, sum(pow(bad - n * prior, 2) - n * prior * (1 - prior)) / sum(n * (n - 1) * prior * (1 - prior)))) - 1 AS m
    FROM suffixes WHERE n > 0),
s AS (SELECT suffix, (bad + m * prior) / (n + m) AS mean FROM suffixes, m0),
dp AS (SELECT d.*, s.mean AS prior FROM domains d JOIN s USING (suffix)),
m1 AS (SELECT 1 / least(0.5, greatest(0.001, sum(pow(bad - n * prior, 2) - n * prior * (1 - prior)) / sum(n * (n - 1) * prior * (1 - prior)))) - 1 AS m
    FROM dp WHERE n > 0),
d AS (SELECT domain, (bad + m * prior) / (n + m) AS mean FROM dp, m1),
hp AS (SELECT h.*, d.mean AS prior FROM hosts h JOIN d USING (domain)),
m2 AS (SELECT 1 / least(0.5, greatest(0.001, sum(pow(bad - n * prior, 2) - n * prior * (1 - prior)) / sum(n * (n - 1) * prior * (1 - prior)))) - 1 AS m
    FROM hp WHERE n > 0),
h AS (SELECT host, n + m AS size, (bad + m * prior) / (n + m) AS mean FROM hp, m2),
ruled AS (
    SELECT page_id, host, path,
        CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
             WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
             WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM parsed)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
         WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN h USING (host)
"""
