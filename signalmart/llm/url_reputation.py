"""Operator 8, URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's rate is
shrunk to the level above by a beta-binomial prior whose strength is estimated from the data (method
of moments, between STRENGTH's bounds: a prior is worth one page at least and a thousand at most); a host
is blocked when the lower bound of its posterior rate of bad pages passes the threshold. The bound is the
normal approximation of the beta posterior's, SIGMAS deviations below its mean. Hosts without labels take
their domain's posterior, or the suffix's. Explicit rules come first: the longest rule whose host and path
fit decides. Everything is DataFrame expressions; counts are aggregated before they are shuffled, and the
joins are per host, not per page.

For its reputation a host is read without user, port and root dot; the host column keeps them. The suffix is
the last label, or two where a country's two letters follow a second level that registries hand out
(SECOND_LEVEL, a rule and not the full list of public suffixes); the registered domain has one label more. An
IP address is a domain of its own, under a suffix that all addresses share.

Null urls and urls without "://" have empty host and path, fit no rule and share the reputation of
the empty host. A label of null counts as no label. Repeated rows count each. Columns of the input pass
unread; one named like a column of the result (host, path, rule, verdict, bad_rate, bad_rate_low) is
replaced by it. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules as (verdict, host/path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
BAD_RATE = 0.5  # a host is blocked if its rate of bad pages surely is above this
SIGMAS = 1.645  # how surely: standard deviations of the posterior below its mean
STRENGTH = (1.0, 1000.0)  # bounds of a prior's strength, in pages


def host_of(url: Column) -> Column:
    """Text behind the first "://" up to "/", "?", "#" or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest rule that fits, or null."""
    fitting = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = F.concat(F.lit("."), host).endswith("." + rule[:at]) & path.startswith(rule[at:])
        here = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        fitting = F.when(fits, here).otherwise(fitting)
    return fitting


#: Second levels under which countries register names.
SECOND_LEVEL = "ac co com edu go gob gouv gov gv ltd mil ne net nom or org plc sch".split()
_TWO_LABELS = rf"(?:^|\.)((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$"


def name_of(host: Column) -> Column:
    """The host without user, port and root dot."""
    for extra in (r"^.*@", r":[0-9]*$", r"\.$"):
        host = F.regexp_replace(host, extra, "")
    return host


def suffix_of(name: Column) -> Column:
    two = F.regexp_extract(name, _TWO_LABELS, 1)
    return F.when(name.rlike(ADDRESS), "[address]").when(two != "", two).otherwise(F.substring_index(name, ".", -1))


def domain_of(name: Column) -> Column:
    """Registered domain: the suffix and the label before it."""
    two = F.regexp_extract(name, _TWO_LABELS, 1) != ""
    return (
        F.when(name.rlike(ADDRESS), name)
        .when(two, F.substring_index(name, ".", -3))
        .otherwise(F.substring_index(name, ".", -2))
    )


def _strength(groups: DataFrame, rate: Column) -> DataFrame:
    """One row `strength`: pages a level's prior is worth, by the spread of rates around `rate`.

    `groups` has `n`, `bad` per member and what `rate` reads. Sums are of integers and of products
    per group, so one pass over the counts is enough.
    """
    apart = F.col("n") * F.pow(F.col("bad") / F.col("n") - rate, 2)
    sums = groups.where("n > 0").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("pages"),
        F.sum(apart).alias("apart"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("inner"),
        F.sum(rate * (1 - rate)).alias("noise"),
    )
    # Between-group variance: what is seen less what chance gives, in units of p(1-p).
    excess = (F.col("apart") - F.col("noise")) / F.col("inner")
    lo, hi = STRENGTH
    strength = (
        F.when(F.coalesce(F.col("inner"), F.lit(0.0)) <= 0, hi)
        .when(excess <= 0, hi)
        .otherwise(F.least(F.lit(hi), F.greatest(F.lit(lo), 1 / excess - 1)))
    )
    return sums.select(strength.alias("strength"))


def _shrunk(groups: DataFrame, above: Column, strength: DataFrame) -> DataFrame:
    """Posterior mean `rate` and pseudo-pages `weight` of every group."""
    return groups.withColumn("_m", strength.scalar()).withColumns(
        {
            "rate": (F.col("bad") + F.col("_m") * above) / (F.col("n") + F.col("_m")),
            "weight": F.col("n") + F.col("_m"),
        }
    ).drop("_m")


def reputation(labelled: DataFrame) -> DataFrame:
    """`host, n, bad, rate, low` per host from `(host, bad)`; `low` is the posterior's lower bound.

    `bad` is 1, 0 or null (no label). The suffix level is shrunk to the rate of all pages.
    """
    hosts = labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    ).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    total = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    suffixes = domains.groupBy("suffix").agg(*total)
    overall = suffixes.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("rate")).scalar()

    suffixes = suffixes.withColumn("above", overall)
    suffixes = _shrunk(suffixes, F.col("above"), _strength(suffixes, F.col("above")))
    domains = domains.join(suffixes.select("suffix", F.col("rate").alias("above")), "suffix")
    domains = _shrunk(domains, F.col("above"), _strength(domains, F.col("above")))
    hosts = hosts.join(domains.select("domain", F.col("rate").alias("above")), "domain")
    hosts = _shrunk(hosts, F.col("above"), _strength(hosts, F.col("above")))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return hosts.select("host", "n", "bad", "rate", (F.col("rate") - SIGMAS * spread).alias("low"))


def judge(pages: DataFrame, url_col: str = "url", bad_col: str = "bad", rules=RULES) -> DataFrame:
    """`pages` with `host, path, rule, verdict, bad_rate, bad_rate_low`."""
    old = {c: f"in_{n}" for n, c in enumerate(pages.columns)}
    url, bad = F.col(old[url_col]), F.col(old[bad_col])
    placed = pages.toDF(*old.values()).withColumns({"host": host_of(url), "path": path_of(url)})
    placed = placed.withColumn("name", name_of(F.col("host")))
    known = reputation(placed.select(F.col("name").alias("host"), bad.cast("long").alias("bad")))
    known = known.select(F.col("host").alias("name"), F.col("rate").alias("bad_rate"), F.col("low").alias("bad_rate_low"))
    judged = placed.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).join(known, "name")
    method = F.when(F.col("bad_rate_low") > BAD_RATE, "block").otherwise("allow")
    new = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("found.rule"),
           "verdict": F.coalesce(F.col("found.verdict"), method), "bad_rate": F.col("bad_rate"),
           "bad_rate_low": F.col("bad_rate_low")}
    kept = [F.col(inner).alias(c) for c, inner in old.items() if c not in new]
    return judged.select(*kept, *[value.alias(c) for c, value in new.items()])

