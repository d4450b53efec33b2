"""URL filters: host and path rules, and an empirical-Bayes reputation of hosts, with DataFrame functions only.

Labelled page outcomes are shrunk through beta-binomial priors: a suffix towards all pages, a registered domain towards its suffix, a
host towards its domain. How strongly a level is shrunk is estimated from the labelled pages themselves, by the method of moments.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Suffixes of two labels under which names are registered; every other suffix is the last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "co.in", "co.kr", "co.za")


class Rule(NamedTuple):
    verdict: str        # allow or block
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one. A rule fits its host, all subdomains, and paths that start with its own."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):        # the last that fits wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without port and user; a host of one label is its own domain and suffix."""
    labels = F.split(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    long = last(2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(long, last(3)).otherwise(last(2)), F.when(long, last(2)).otherwise(last(1))


def _shrunk(groups: DataFrame, prior: Column, unsure: Column, mean: str) -> DataFrame:
    """Adds the posterior mean of each group (n, y) under its prior mean, and its variance, of which the prior's own is a part.

    With m the prior mean, n (y/n - m)^2 is m (1 - m) (1 + (n - 1) rho) on average, which gives rho, the correlation within a group;
    the strength is (1 - rho) / rho pages.
    """
    with_prior = groups.withColumn("prior", prior)
    spread = F.col("prior") * (1 - F.col("prior"))
    rho = with_prior.where("n > 0").agg((F.sum(F.col("n") * F.pow(F.col("y") / F.col("n") - F.col("prior"), 2) - spread) / F.sum((F.col("n") - 1) * spread)).alias("rho"))
    rho = rho.select(F.least(F.greatest(F.coalesce(F.col("rho"), F.lit(0.0)), F.lit(0.001)), F.lit(0.999)).alias("rho"))
    strength = ((1 - F.col("rho")) / F.col("rho")).alias("strength")
    fitted = with_prior.withColumn("strength", rho.select(strength).scalar()).withColumn(mean, (F.col("y") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength")))
    on_prior = F.col("strength") / (F.col("n") + F.col("strength"))
    return fitted.withColumn(f"{mean}_variance", F.col(mean) * (1 - F.col(mean)) / (F.col("n") + F.col("strength") + 1) + on_prior * on_prior * unsure)


def host_reputation(hosts: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, y, good_rate, low, high) for every host: the shrunk share of good pages and its posterior bounds.

    ``hosts`` has a column host, one row each; ``outcomes`` has host and good (0 or 1), one row per labelled page; nulls in either are left
    out. A host without labelled pages has what its domain, suffix or all pages say. Without any outcome the rate is one half. Only
    counts per host, domain and suffix are kept, so a host may own any share of the pages. Bounds are ``z`` posterior deviations off.
    """
    counts = outcomes.where("host is not null and good is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("y"))
    domain, suffix = domain_and_suffix(F.col("host"))
    every = hosts.select("host").unionByName(counts.select("host")).where("host is not null").distinct().join(counts, "host", "left")
    base = materialize(every.select("host", domain.alias("domain"), suffix.alias("suffix"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("y", F.lit(0)).alias("y")))
    everywhere = base.agg(((F.sum("y") + 0.5) / (F.sum("n") + 1.0)).alias("m"))
    totals = [F.sum("n").alias("n"), F.sum("y").alias("y")]
    suffixes = _shrunk(base.groupBy("suffix").agg(*totals), F.coalesce(everywhere.scalar(), F.lit(0.5)), F.lit(0.0), "of_suffix").select("suffix", "of_suffix", "of_suffix_variance")
    domains = base.groupBy("domain", "suffix").agg(*totals).join(suffixes, "suffix")
    domains = _shrunk(domains, F.col("of_suffix"), F.col("of_suffix_variance"), "of_domain").select("domain", "suffix", "of_domain", "of_domain_variance")
    shrunk = _shrunk(base.join(domains, ["domain", "suffix"]), F.col("of_domain"), F.col("of_domain_variance"), "good_rate")
    deviation = F.sqrt("good_rate_variance")
    return shrunk.select("host", "n", "y", "good_rate", (F.col("good_rate") - z * deviation).alias("low"), (F.col("good_rate") + z * deviation).alias("high"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], min_good: float = 0.5, z: float = 1.645) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, good_rate.

    ``pages`` has page_id and url; ``outcomes`` has host and good of labelled pages. A rule decides where one fits. Else a page is blocked
    when even the upper posterior bound of its host's share of good pages is below ``min_good``. Pages without a host are judged as a host
    named by the empty string. Repeated pages are judged alike, each in its own row.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    reputation = host_reputation(parsed.select("host"), outcomes, z).select("host", "good_rate", "high")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.join(reputation, "host", "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("high") < min_good, "block").otherwise("allow")).alias("verdict"), "good_rate")
