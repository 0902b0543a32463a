"""URL filters: fixed rules, and empirical-Bayes host reputation for the rest.

A page's outcome is bad if its label says toxic or low quality (labels go with
the page of the same id).  Rates of bad pages are shrunk from host to
registered domain to suffix to all pages: each level's rate is a beta-binomial
posterior mean whose prior is the level above, with a strength that the
level's own overdispersion gives by moments.  A host is blocked where the
lower bound of its posterior (mean - ``Z`` standard deviations) exceeds
``BAD_RATE``.

The suffix of a host is the longest of ``suffixes`` (like ``co.uk``; a parameter,
empty by default) that it ends with, else its last label; the registered domain
is the suffix and the label before it.  Hosts are counted once, into a table in
the checkpoint folder, from which all levels are read.
Counts combine before each shuffle, so that a hot host costs no more than
others; only three numbers (the levels' overdispersions) reach the driver.

Edge cases.  A null url, or one without ``://``, has an empty host and path
and is judged as the empty host.  Labels without a page, null ids and null
labels count for nothing; several labels of an id are bad if one is.
Unlabelled hosts have the posterior of their domain's prior.  Without any
labels nothing is blocked but by rules.  Repeated pages are judged alike, and
their outcomes count once for each row.  Only the named columns are read; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Scratch

Z = 1.645
BAD_RATE = 0.5
#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (like ``net/``) and its verdict; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def overdispersion(units: DataFrame) -> float:
    """Correlation of outcomes within units of (n, bad, prior), by moments, kept within [0.001, 0.5]."""
    v = F.col("prior") * (1 - F.col("prior"))
    r = units.where("n > 0").agg(
        F.sum((F.col("bad") - F.col("n") * F.col("prior")) ** 2 - F.col("n") * v).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * v).alias("room")).first()
    return min(0.5, max(0.001, r.over / r.room)) if r.room else 0.5


def registered(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    domain, suffix = F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0), F.element_at(F.split(host, r"\."), -1)
    for s in sorted(suffixes, key=len):
        fits = (host == s) | host.endswith("." + s)
        domain = F.when(fits, F.regexp_extract(host, r"([^.]*\.)?" + re.escape(s) + "$", 0)).otherwise(domain)
        suffix = F.when(fits, F.lit(s)).otherwise(suffix)
    return domain, suffix


def reputations(hosts: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, n, bad) -> host, low: the posterior's lower bound; shrunk from host to domain to suffix."""
    domain, suffix = registered(F.col("host"), suffixes)
    units = hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    domains = units.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_ = tops.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = all_.bad / all_.n if all_.n else 0.0

    def posterior(level: DataFrame) -> tuple[DataFrame, float]:
        m = 1 / overdispersion(level) - 1
        return level.withColumn("mean", (F.col("bad") + m * F.col("prior")) / (F.col("n") + m)), m

    tops, _ = posterior(tops.withColumn("prior", F.lit(rate)))
    domains, _ = posterior(domains.join(tops.select("suffix", F.col("mean").alias("prior")), "suffix"))
    out, m = posterior(units.join(domains.select("domain", F.col("mean").alias("prior")), "domain"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + m + 1))
    return out.select("host", (F.col("mean") - Z * sd).alias("low"))


def judged(pages: DataFrame, labels: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
           label_id_col: str = "doc_id", bad_rate: float = BAD_RATE, suffixes: Sequence[str] = ()) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = host_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    outcome = labels.where(F.col(label_id_col).isNotNull()).groupBy(F.col(label_id_col).alias("page_id")).agg(
        F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)).alias("bad"))
    known = parsed.where("page_id is not null").join(outcome, "page_id").groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    hosts = parsed.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad")).distinct().unionByName(known)
    hosts = Scratch(pages.sparkSession, "hosts").write(
        hosts.groupBy("host").agg(F.sum("n").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    return parsed.join(reputations(hosts, suffixes), "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("low") > bad_rate, "block").otherwise("allow")).alias("verdict"))
