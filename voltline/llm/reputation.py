"""Url filter by rules and empirical-Bayes host reputation.

A url's verdict is that of the longest rule that fits.  Without one, the host's
reputation decides: labelled page outcomes (good / bad) are shrunk through
beta-binomial priors from host to registered domain to suffix to the whole
corpus.  Each level's prior has its parent's posterior mean and one strength,
estimated from the spread of the level's units by the method of moments.  A
host is blocked when the lower posterior bound of its bad rate exceeds a
threshold, so few bad pages do not block a host and a bad neighbourhood counts.

Only built-in Spark expressions; pages are reduced to counts by host before
any other shuffle, so a host with a third of the pages is no hot key.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule, and is judged as host ''; repeated pages count as often as they
occur; several labels of one page count as its worst; no labels at all: every
page without a rule is allowed; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import materialise, sized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"
MAX_BAD = 0.5  # block when the bad rate's lower bound exceeds this
Z = 1.645  # one-sided 95 % bound
RHO = (0.001, 0.999)  # range of the estimated correlation within a unit
# Public suffixes of two labels that are common; one label otherwise.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
                      "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.tr")


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules.
RULES = (UrlRule("org", "/", "allow"), UrlRule("example.org", "/es/", "block"),
         UrlRule("example.org", "/en/1", "block"), UrlRule("com", "/fr/", "allow"),
         UrlRule("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def with_rule(df: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """Adds rule and rule_verdict (null where none fits) to host, path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest comes last, so outermost
        fits = (((F.col("host") == r.host) | F.col("host").endswith("." + r.host))
                & F.col("path").startswith(r.path))
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return df.withColumn("rule", name).withColumn("rule_verdict", verdict)


def _levels(hosts: DataFrame) -> DataFrame:
    last2 = F.substring_index("host", ".", -2)
    two = last2.isin(*TWO_LABEL_SUFFIXES)
    return (hosts.withColumn("suffix", F.when(two, last2).otherwise(F.substring_index("host", ".", -1)))
            .withColumn("domain", F.when(two, F.substring_index("host", ".", -3)).otherwise(last2)))


def _shrink(units: DataFrame, parent: DataFrame, unit: str, on: list[str]) -> DataFrame:
    """Posterior (a, b) of each unit under its parent's mean m, which is taken
    without the unit's own outcomes, so no outcome counts twice.  ``parent``:
    its posterior pa, pb."""
    joined = units.join(sized(parent), on) if on else units.crossJoin(F.broadcast(parent))  # parent: one row
    joined = joined.withColumn("m", (F.col("pa") - F.col("bad")) / (F.col("pa") + F.col("pb") - F.col("n")))
    spread = F.col("m") * (1 - F.col("m"))
    strength = (joined.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), F.lit(2))).alias("s"),
        F.sum(spread).alias("e"), F.sum(spread * (F.col("n") - 1)).alias("w"))
        .select(F.least(F.greatest(F.coalesce((F.col("s") - F.col("e")) / F.nullif(F.col("w"), F.lit(0.0)),
                                              F.lit(RHO[0])), F.lit(RHO[0])), F.lit(RHO[1])).alias("rho"))
        .select((1 / F.col("rho") - 1).alias("k")))
    a = F.col("bad") + F.col("k") * F.col("m")
    b = F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("m"))
    return materialise(joined.crossJoin(F.broadcast(strength)).withColumn("a", a).withColumn("b", b),  # one row
                       f"reputation-{unit}")


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, n, bad, bad_rate, lower.  ``pages``: page_id, host;
    ``outcomes``: page_id, bad (0/1; null is no outcome)."""
    known = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = _levels(materialise(
        pages.join(known, "page_id", "left").groupBy("host").agg(
            F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "reputation-counts"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5).alias("pa"),
                         (F.coalesce(F.sum(F.col("n") - F.col("bad")), F.lit(0)) + 0.5).alias("pb"))
    above = [F.col("a").alias("pa"), F.col("b").alias("pb")]
    by_suffix = _shrink(suffixes, whole, "suffix", [])
    by_domain = _shrink(domains, by_suffix.select("suffix", *above), "domain", ["suffix"])
    by_host = _shrink(hosts, by_domain.select("suffix", "domain", *above), "host", ["suffix", "domain"])
    a, b = F.col("a"), F.col("b")
    rate = a / (a + b)
    sd = F.sqrt(a * b / (F.pow(a + b, F.lit(2)) * (a + b + 1)))
    return by_host.select("host", "n", "bad", rate.alias("bad_rate"), (rate - Z * sd).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[UrlRule, ...] = RULES,
          max_bad: float = MAX_BAD) -> DataFrame:
    """page_id, host, path, rule, verdict, lower (the host's bound)."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    reputation = host_reputation(parsed.select("page_id", "host"), outcomes).select("host", "lower")
    by_method = F.when(F.col("lower") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return (with_rule(parsed, rules).join(sized(reputation), "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"),
                    "lower"))
