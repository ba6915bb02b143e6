"""URL filtering by rules and by empirical-Bayes host reputation.

Labelled outcomes of pages are counted by host. A host's rate of good pages is beta-distributed around its registered
domain's, that around its suffix's, and that around the overall rate. The concentration of each level is estimated from
the overdispersion of all groups of that level (method of moments). A host is allowed if the lower bound of its
posterior (mean less some standard deviations) reaches a threshold; hosts without outcomes have their domain's mean.
Plain DataFrame operations throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import columns_without, cut_lineage, quoted, spare_names

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Standard deviations below the mean, and the least bound that is allowed.
DEVIATIONS, THRESHOLD = 1.645, 0.5
LEAST, MOST = 1.0, 10_000.0


def host_column(url: str) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if null or without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(quoted(url), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_column(url: str) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(quoted(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host, path) that fits columns host and path, as text and verdict; else null.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    rule = verdict = None
    for said, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    none = F.lit(None).cast("string")
    return (none if rule is None else rule), (none if verdict is None else verdict)


def domain_column(host: Column) -> Column:
    """The last two labels of a host: its registered domain."""
    return F.regexp_extract(host, r"([^.]+\.)?[^.]*$", 0)


def suffix_column(host: Column) -> Column:
    return F.regexp_extract(host, r"[^.]*$", 0)


def _concentration(groups: DataFrame) -> float:
    """Of groups (good, n, mean: what the parent expects): 1 / overdispersion - 1, in bounds."""
    labelled = groups.where("n > 0 and mean > 0 and mean < 1")
    gap = F.col("good") / F.col("n") - F.col("mean")
    spread = F.col("mean") * (1 - F.col("mean"))
    row = labelled.agg((F.sum(F.col("n") * gap * gap / spread) / F.count("*")).alias("v"), F.avg("n").alias("n")).first()
    if row["v"] is None or row["n"] <= 1 or row["v"] <= 1:
        return MOST
    return min(MOST, max(LEAST, (row["n"] - 1) / (row["v"] - 1) - 1))


def host_reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, reputation (posterior mean), bound (its lower bound), for every host of `hosts` (host) or `outcomes` (host, good: boolean).

    Outcomes with a null host or good are left out. Without outcomes every reputation is 1/2. Counts by host are written
    once; all levels come from them.
    """
    n = outcomes.where("host is not null and good is not null").select("host", F.col("good").cast("long").alias("good"), F.lit(1).cast("long").alias("n"))
    every = hosts.select("host").where("host is not null").select("host", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("n"))
    by_host = every.union(n).groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    by_host = cut_lineage(by_host.withColumns({"domain": domain_column(F.col("host")), "suffix": suffix_column(F.col("host"))}))
    by_domain = cut_lineage(by_host.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = by_domain.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = (total["good"] + 1) / (total["n"] + 2) if total["n"] else 0.5

    def posterior(groups: DataFrame, name: str) -> DataFrame:
        m = _concentration(groups)
        a, b = F.col("good") + m * F.col("mean"), F.col("n") - F.col("good") + m * (1 - F.col("mean"))
        return groups.withColumns({name: a / (a + b), name + "_sd": F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))})

    suffixes = posterior(by_suffix.withColumn("mean", F.lit(overall)), "rate").select("suffix", F.col("rate").alias("mean"))
    domains = posterior(by_domain.join(suffixes, "suffix"), "rate").select("domain", "suffix", F.col("rate").alias("mean"))
    found = posterior(by_host.join(domains, ["domain", "suffix"]), "reputation")
    return found.select("host", "reputation", (F.col("reputation") - DEVIATIONS * F.col("reputation_sd")).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]], url_column: str = "url", threshold: float = THRESHOLD) -> DataFrame:
    """Adds host, path, rule (null if none fits), verdict (`allow` or `block`: the rule's, else by reputation).

    A null url, or one without `://`, has an empty host and path, and the reputation of the empty host. A host is taken as
    it stands: a port or user name is part of it, and its domain is its last two labels, whatever they are (`co.uk` is
    a domain of the suffix `uk`, below which its hosts share a reputation). Repeated rows, empty tables and other columns,
    whatever their names, pass through; columns with an added column's name are replaced.
    """
    added = ("host", "path", "rule", "verdict")
    judged, bound = spare_names([*pages.columns, *added], "_judged", "_bound")
    parsed = pages.select(*columns_without(pages, *added), host_column(url_column).alias("host"), path_column(url_column).alias("path"))
    found = host_reputation(parsed.select("host"), outcomes).select(F.col("host").alias(judged), F.col("bound").alias(bound))
    rule, said = rule_columns(rules)
    method = F.when(F.col(bound) >= threshold, "allow").otherwise("block")
    rows = parsed.join(found, F.col("host") == F.col(judged), "left").withColumns({"rule": rule, "verdict": F.coalesce(said, method)})
    return rows.drop(bound, judged)
