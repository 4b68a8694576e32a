"""URL filters: rules by host and path, and an empirical-Bayes reputation of hosts.

Labelled page outcomes are counted by host, registered domain and suffix. Each level's
rate of bad pages is shrunk by a beta-binomial prior towards the level above it: host to
domain, domain to suffix, suffix to all pages. A host is blocked when even the lower
bound of its posterior rate is above the limit, so hosts with few labels are let through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import let
from changetables.llm.common import broadcast_if_small, shrunk
from changetables.session import materialise

# Suffixes of two labels, below which domains are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")


@dataclass(frozen=True)
class Reputation:
    """Block above ``limit`` for the posterior mean less ``deviations`` standard deviations.

    The priors' weights, in labelled pages, are fitted and kept within the two bounds.
    """

    limit: float = 0.5
    deviations: float = 2.0
    least_weight: float = 2.0
    most_weight: float = 1000.0


def host_and_path(url: Column) -> Column:
    """Struct (host, path) of a url; both empty if it is null or has no ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return let(
        F.coalesce(rest, F.lit("")),
        lambda r: F.struct(
            F.translate(F.regexp_extract(r, "^[^/?#]*", 0), upper, upper.lower()).alias("host"),
            F.regexp_extract(r, "^[^/?#]*([^?#]*)", 1).alias("path"),
        ),
    )


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def suffix_of(domain: Column) -> Column:
    """Public suffix of a registered domain."""
    two = F.substring_index(domain, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(domain, ".", -1))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    ``rules`` maps a rule such as ``example.com/en/`` to ``allow`` or ``block``; it is
    the caller's own list and lives in the plan.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules.items(), key=lambda x: (len(x[0]), x[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def reputations(pages: DataFrame, outcomes: DataFrame, how: Reputation = Reputation()) -> DataFrame:
    """One row per host of ``pages`` (host, doc_id): n, bad, rate, bound and blocked.

    ``outcomes`` has (doc_id, bad); rows of one document count once, as bad if one is.
    Without any labels all hosts have the rate 1/2 and none is blocked.
    """
    labels = outcomes.groupBy("doc_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counted = (
        pages.groupBy("host", "doc_id")
        .agg(F.count(F.lit(1)).alias("pages"))
        .join(labels, "doc_id", "left")
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("bad").isNotNull(), F.col("pages")).otherwise(0)).alias("n"),
            F.sum(F.coalesce(F.col("bad") * F.col("pages"), F.lit(0))).alias("bad"),
        )
        .withColumn("domain", domain_of(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("domain")))
    )
    hosts = materialise(counted, "host-outcomes")
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    above = F.lit(((total[1] or 0) + 0.5) / ((total[0] or 0) + 1.0))

    bounds = (how.least_weight, how.most_weight)
    suffixes = shrunk(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("above", above), *bounds)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("above")), "suffix"), *bounds)
    rated = shrunk(hosts.join(domains.select("domain", F.col("rate").alias("above")), "domain"), *bounds)
    rate = F.col("rate")
    bound = rate - how.deviations * F.sqrt(rate * (1 - rate) / (F.col("weight") + 1))
    return rated.select("host", "n", "bad", "rate", bound.alias("bound"), (bound > how.limit).alias("blocked"))


def judge(
    pages: DataFrame, outcomes: DataFrame, doc_id: Column, rules: dict[str, str], how: Reputation = Reputation(), url: str = "url"
) -> DataFrame:
    """``pages`` with a struct ``judged``: host, path, rule, verdict, n_labels, n_bad, bad_rate, bad_bound.

    ``doc_id`` is the column expression that links a page to its outcome; null where it
    has none. A rule decides where one fits, else the reputation of the host. Every input
    row comes back. A column of the name ``judged`` is replaced.
    """
    parts = host_and_path(F.col(url))
    known = materialise(
        reputations(pages.select(parts["host"].alias("host"), doc_id.alias("doc_id")), outcomes, how), "host-reputations"
    )
    known = known.select(F.col("host").alias("__host"), F.struct(*known.columns[1:]).alias("__known"))
    joined = (
        pages.withColumn("__parts", parts)
        .withColumn("__host", F.col("__parts.host"))
        .join(broadcast_if_small(known, 400), "__host", "left")
        .withColumn("__rule", rule_of(F.col("__parts.host"), F.col("__parts.path"), rules))
    )
    method = F.when(F.col("__known.blocked"), "block").otherwise("allow")
    return joined.withColumn(
        "judged",
        F.struct(
            F.col("__parts.host").alias("host"),
            F.col("__parts.path").alias("path"),
            F.col("__rule.rule").alias("rule"),
            F.coalesce(F.col("__rule.verdict"), method).alias("verdict"),
            F.col("__known.n").alias("n_labels"),
            F.col("__known.bad").alias("n_bad"),
            F.col("__known.rate").alias("bad_rate"),
            F.col("__known.bound").alias("bad_bound"),
        ),
    ).drop("__parts", "__host", "__known", "__rule")
