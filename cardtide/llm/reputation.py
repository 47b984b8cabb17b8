"""URL rules, and host reputation by empirical Bayes, in built-in functions alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardtide.llm.common import HIDDEN, landed
from cardtide.operators.skew import join_spread

HOST, PATH, RULE, VERDICT, MEAN, BOUND = (f"{HIDDEN}{x}" for x in ("host", "path", "rule", "verdict", "mean", "bound"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or one without ``://``."""
    host, path = (F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", i), F.lit("")) for i in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def matched_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits as a struct (rule, verdict), or null; of equal lengths the first in the alphabet.

    A rule fits its host and all subdomains, if the path starts with its own. ``rules`` are a written list, tried in turn.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path), reverse=True):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def name_levels(host: Column, double_suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host: its last two labels and its last one.

    Where the last two labels are in ``double_suffixes`` they are the suffix, and the domain has three. User names and ports are
    no part of a name; an address of digits is its own domain and suffix.
    """
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    last = F.substring_index(name, ".", -1)
    two = F.substring_index(name, ".", -2)
    if double_suffixes:
        double = two.isin(list(double_suffixes))
        suffix = F.when(double, two).otherwise(last)
        domain = F.when(double, F.substring_index(name, ".", -3)).otherwise(two)
    else:
        suffix, domain = last, two
    address = name.rlike("^[0-9.]+$")
    return F.when(address, name).otherwise(domain), F.when(address, name).otherwise(suffix)


def _strength(groups: DataFrame, prior: str) -> Column:
    """Prior strength of a level (as a scalar subquery): from the analysis of variance between and within groups.

    ``groups`` have ``n`` outcomes, ``good`` of them good, and the mean of their prior. Without enough groups the
    strength is that of the greatest correlation allowed, so that groups speak for themselves.
    """
    rate = F.col("good") / F.col("n")
    sums = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * (rate - F.col(prior)) * (rate - F.col(prior))).alias("between"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("within"),
    )
    between = F.col("between") / (F.col("k") - 1)
    within = F.col("within") / (F.col("total") - F.col("k"))
    size = (F.col("total") - F.col("squares") / F.col("total")) / (F.col("k") - 1)
    shared = (between - within) / (between + (size - 1) * within)
    usable = (F.col("k") > 1) & (F.col("total") > F.col("k")) & (between + (size - 1) * within > 0)
    shared = F.when(usable, F.least(F.greatest(shared, F.lit(0.001)), F.lit(0.9))).otherwise(0.9)
    return sums.select((1 / shared - 1).alias("strength")).scalar()


def host_reputation(outcomes: DataFrame, prior: float = 0.5, z: float = 1.645, double_suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, mean, bound): the posterior mean of a host's good share, and the upper bound at ``z`` deviations.

    ``outcomes`` have a ``host`` and ``good`` (1, 0, or null for a page without a label); every host in it gets a row. Beta-binomial
    posteriors are shrunk level by level: the suffix towards the overall share, the registered domain towards its suffix, the host
    towards its domain. A level's strength comes from how much its groups differ. Without any label the overall share is ``prior``.
    """
    hosts = outcomes.groupBy("host").agg(
        F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"), F.count("good").cast("double").alias("n")
    )
    domain, suffix = name_levels(F.col("host"), double_suffixes)
    # Read by every level below: one row per host.
    hosts = landed(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    overall = hosts.agg(F.when(F.sum("n") > 0, F.sum("good") / F.sum("n")).otherwise(prior).alias("share")).scalar()

    def shrunk(groups: DataFrame) -> DataFrame:
        strength = _strength(groups, "prior")
        return groups.withColumn("mean", (F.col("good") + strength * F.col("prior")) / (F.col("n") + strength)).withColumn(
            "weight", F.col("n") + strength
        )

    # A level's strength reads all of the level above: written, each is worked out once.
    totals = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    suffixes = landed(shrunk(hosts.groupBy("suffix").agg(*totals).withColumn("prior", overall)), "suffixes")
    domains = hosts.groupBy("domain", "suffix").agg(*totals).join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = landed(shrunk(landed(domains, "domain-priors")), "domains")
    found = shrunk(landed(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"]), "host-priors"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return found.select("host", "mean", (F.col("mean") + z * deviation).alias("bound"))


def judged_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[UrlRule],
    url_col: str = "url",
    least: float = 0.5,
    z: float = 1.645,
    double_suffixes: Sequence[str] = (),
) -> DataFrame:
    """All rows and columns of ``pages`` with HOST, PATH, RULE, VERDICT, MEAN and BOUND.

    ``outcomes`` have (host, good), for every host of ``pages`` (good is null where nothing is known). The verdict is that of the longest
    rule that fits; else ``block`` where even the upper posterior bound of the host's good share is below ``least``, and ``allow``
    otherwise. A null url, or one without ``://``, has an empty host and path, and the verdict of that host. Repeated rows stay; one host may have
    most of the rows: it is one row of the reputation, and its pages meet it in a join that is spread over several sub-keys.
    """
    host, path = url_parts(F.col(url_col))
    parted = pages.withColumns({HOST: host, PATH: path})
    known = host_reputation(outcomes, z=z, double_suffixes=double_suffixes).select(
        F.col("host").alias(HOST), F.col("mean").alias(MEAN), F.col("bound").alias(BOUND)
    )
    rule = f"{HIDDEN}matched"
    return (
        join_spread(parted, known, [HOST], [PATH], 8)
        .withColumn(rule, matched_rule(F.col(HOST), F.col(PATH), rules))
        .withColumn(RULE, F.col(rule)["rule"])
        .withColumn(VERDICT, F.coalesce(F.col(rule)["verdict"], F.when(F.col(BOUND) < least, "block").otherwise("allow")))
        .drop(rule)
    )
