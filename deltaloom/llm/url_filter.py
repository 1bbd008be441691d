"""URL rules and empirical-Bayes host reputation.

A rule names a host and a path prefix; it fits that host and all its subdomains, and the longest fitting rule decides. Pages without a
rule are judged by their host: labelled outcomes are shrunk through beta-binomial priors from the host to its registered domain, its
suffix and all pages. The strength of each level's prior is estimated from the spread of the rates within that level. A host is blocked
if the lower bound of its posterior bad rate is above a threshold.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is judged by the reputation of the empty
host. Hosts without outcomes have their parents' rate. Without any outcome nothing is blocked. Each page row gives one row, repeated ones too; a repeated
page counts as often as it stands there. Urls may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.llm.text import lower_ascii
from deltaloom.storage import cut_lineage

#: (verdict, host, path) of the fixed rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Rules are matched by literals in the plan: a hand-written list, not data.
MOST_RULES = 5_000

#: Lower bound of the posterior: mean minus so many standard deviations, against the threshold.
DEVIATIONS, THRESHOLD = 1.645, 0.5


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits; of equally long ones that with the longer host."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


#: Second-level labels under which others register, by country: public suffixes of two labels that exist (fixed values, a selection).
PUBLIC = {
    "uk": "ac co gov ltd me net nhs org plc police sch",
    "au": "asn com edu gov id net org",
    "nz": "ac co govt net org school",
    "jp": "ac ad co ed go gr lg ne or",
    "kr": "ac co go ne or pe re",
    "in": "ac co edu firm gen gov ind net nic org res",
    "za": "ac co gov law net nom org school web",
    "il": "ac co gov k12 muni net org",
    "br": "art com edu eng gov ind net org",
    "cn": "ac com edu gov mil net org",
    "tw": "com edu gov idv mil net org",
    "hk": "com edu gov idv net org",
    "sg": "com edu gov net org per",
    "my": "com edu gov mil name net org",
    "th": "ac co go in mi net or",
    "id": "ac co go mil my net or sch web",
    "ph": "com edu gov mil net ngo org",
    "vn": "com edu gov net org",
    "tr": "com edu gov net org",
    "mx": "com edu gob net org",
    "ar": "com edu gob gov net org",
    "co": "com edu gov net org",
    "pe": "com edu gob net org",
    "es": "com edu gob nom org",
    "ua": "com edu gov in net org",
    "fr": "asso com gouv nom",
    "pt": "com edu gov org",
    "gr": "com edu gov net org",
}
SUFFIXES = sorted(f"{label}.{country}" for country, labels in PUBLIC.items() for label in labels.split())


def _site(host: Column) -> Column:
    """A host without its port."""
    return F.regexp_replace(host, r":[0-9]*$", "")


def _address(site: Column) -> Column:
    return site.rlike(r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])$")


def domain(host: Column) -> Column:
    """Registered domain: the public suffix and one label more; an IP address whole."""
    site = _site(host)
    two = F.substring_index(site, ".", -2)
    return F.when(_address(site), site).when(two.isin(SUFFIXES), F.substring_index(site, ".", -3)).otherwise(two)


def suffix(host: Column) -> Column:
    """Public suffix: one of the listed ones of two labels, else the last label; an IP address whole."""
    site = _site(host)
    two = F.substring_index(site, ".", -2)
    return F.when(_address(site) | two.isin(SUFFIXES), F.when(_address(site), site).otherwise(two)).otherwise(F.substring_index(site, ".", -1))


def _strength(groups: DataFrame, parent: str) -> DataFrame:
    """One row: prior strength of a level, by moments of the groups' rates around their parents' means."""
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col(parent), F.lit(2.0)) / F.greatest(F.col(parent) * (1 - F.col(parent)), F.lit(1e-6))
    rows = groups.where("n > 0").agg(
        F.coalesce(F.sum(spread), F.lit(0.0)).alias("spread"), F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("spare")
    )
    rho = F.least(F.greatest((F.col("spread") - F.col("groups")) / F.greatest(F.col("spare"), F.lit(1)), F.lit(0.001)), F.lit(0.5))
    return rows.select((1 / rho - 1).alias("strength"))


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior per host from frame (host, n, bad): ``mean`` and ``bound`` of the bad rate.

    ``n`` and ``bad`` are counts of labelled pages, both 0 for hosts without. Only per-host sums are shuffled.
    """
    hosts = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # every level and its strength read these few rows again: written once each
    hosts = cut_lineage(hosts.withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("host"))), "hosts")
    domains = cut_lineage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m0"))

    def shrink(level: DataFrame, parent: str, out: str) -> DataFrame:
        level = level.withColumn("strength", _strength(level, parent).scalar())
        return level.withColumn(out, (F.col("bad") + F.col("strength") * F.col(parent)) / (F.col("n") + F.col("strength")))

    suffixes = cut_lineage(shrink(suffixes.withColumn("m0", whole.scalar()), "m0", "m1").select("suffix", "m1"), "suffixes")
    domains = cut_lineage(shrink(domains.join(suffixes, "suffix"), "m1", "m2").select("domain", "m2"), "domain-rates")
    hosts = shrink(hosts.join(domains, "domain"), "m2", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Verdict per page. ``outcomes``: frame (outcome_id, bad 0/1) of labelled pages; a page labelled more than once is bad if any label is."""
    parts = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    labels = outcomes.groupBy("outcome_id").agg(F.max("bad").alias("bad"))
    seen = parts.join(labels, F.col("page_id") == F.col("outcome_id"), "left").select(
        "host", F.col("bad").isNotNull().cast("long").alias("n"), F.coalesce(F.col("bad"), F.lit(0)).cast("long").alias("bad")
    )
    hosts = reputation(seen).select(F.col("host").alias("judged"), "bound")
    found = rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return (
        parts.withColumn("found", found)
        .join(hosts, F.col("host") == F.col("judged"), "left")
        .select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce(F.col("found.verdict"), by_host).alias("verdict"), F.col("bound").alias("bad_bound"))
    )
