"""URL filter by empirical-Bayes host reputation.

Labelled pages count as good or bad outcomes of their host.  The share of bad pages is estimated on three
levels, each a beta-binomial with the level above as prior: suffix (around the share of all pages), registered
domain (around its suffix), host (around its domain).  The strength of a level's prior comes from the data by
moments: the less its members differ beyond chance, the more they are shrunk.  A host is blocked if the lower
posterior bound of its bad share exceeds a threshold, so a few bad pages do not block a host of a good domain.
Explicit rules (host and path prefix) come first; the longest that fits decides.

Everything is DataFrame expressions; only three pairs of sums reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels, below which names are registered; others have one label.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za", "com.mx")
STRONGEST = 10_000.0
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    """The registered domain: one label below the suffix, or the host itself if it has no more."""
    labels = F.split(host, r"\.")
    keep = F.when(F.array_join(F.slice(labels, -2, 2), ".").isin(*DOUBLE_SUFFIXES), 3).otherwise(2)
    return F.when(F.size(labels) <= keep, host).otherwise(F.array_join(F.slice(labels, F.size(labels) - keep + 1, keep), "."))


def suffix_of(domain: Column) -> Column:
    labels = F.split(domain, r"\.")
    return F.when(F.size(labels) < 2, domain).otherwise(F.array_join(F.slice(labels, 2, F.size(labels)), "."))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(text, verdict) of the longest rule that fits (of equals the last by text), or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules")
    fits = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
                   F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")))
            for r in rules]
    none = F.lit(None).cast("struct<size:int,text:string,verdict:string>")
    return F.array_max(F.array(*fits, none))


def _strength(members: DataFrame, mean: str) -> float:
    """Prior strength (alpha + beta) of a level by moments: members have n, bad and the prior's ``mean``."""
    m = F.col(mean)
    row = members.where("n > 0").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - m) * (F.col("bad") / F.col("n") - m)).alias("spread"),
        F.sum(m * (1 - m)).alias("chance"), F.sum(F.col("n") * m * (1 - m)).alias("most")).first()
    if not row["n"]:
        return 1.0  # nothing is known
    beyond = (row["spread"] - row["chance"]) / row["n"]
    if beyond <= 0 or not row["most"]:
        return STRONGEST
    return min(STRONGEST, max(1.0, row["most"] / row["n"] / beyond - 1))


def reputations(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, bad boolean or null) -> per host: domain, suffix, n and bad counts, posterior mean and lower bound of
    its bad share (mean - z standard deviations).  Rows with a null outcome count as unlabelled pages of their host;
    a null host is the empty one; an empty table gives no rows."""
    hosts = checkpoint(outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host"))
                       .agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
                       .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain"))))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    prior = (total["bad"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5

    def level(members: DataFrame, key: str, mean: Column) -> DataFrame:
        own = members.withColumn("prior", mean)
        s = F.lit(_strength(own, "prior"))
        return own.withColumn("strength", s).withColumn(f"{key}_mean", (F.col("prior") * s + F.col("bad")) / (s + F.col("n")))

    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = checkpoint(level(hosts.groupBy("suffix").agg(*sums), "suffix", F.lit(prior)).select("suffix", "suffix_mean"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = checkpoint(level(domains, "domain", F.col("suffix_mean")).select("domain", "domain_mean"))
    found = level(checkpoint(hosts.join(domains, "domain")), "host", F.col("domain_mean"))
    size, mean = F.col("strength") + F.col("n"), F.col("host_mean")
    return found.select("host", "domain", "suffix", "n", "bad", mean.alias("bad_share"),
                        (mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (size + 1))).alias("bad_bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float = 0.3, z: float = 1.645,
          url: str = "url", key: str = "page_id", outcome_key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, bad_share, bad_bound) for every row of ``pages``.

    ``outcomes`` is (outcome_key, bad boolean): labelled pages by key; repeated ones count each time, null ones not.
    The verdict is the longest fitting rule's, else ``block`` if the lower posterior bound of the host's bad share is
    over ``threshold``, else ``allow``.  A null url, or one without ``://``, has an empty host and path, judged like
    any other host.  Keys may be null (unlabelled) or repeated."""
    own = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = outcomes.select(F.col(outcome_key).alias("_of"), F.col("bad").alias("bad"))
    known = reputations(own.join(labels, F.col("_key") == F.col("_of"), "left").select("host", "bad"), z)
    known = checkpoint(known.select("host", "bad_share", "bad_bound"))
    found = own.join(known, "host", "left").withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    return found.select(F.col("_key").alias("key"), "host", "path", F.col("_rule.text").alias("rule"),
                        F.coalesce(F.col("_rule.verdict"), F.when(F.col("bad_bound") > threshold, "block").otherwise("allow")).alias("verdict"),
                        "bad_share", "bad_bound")
