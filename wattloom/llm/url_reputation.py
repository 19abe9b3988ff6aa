"""URL filter by listed rules and by a host's shrunk reputation.

Labelled outcomes of pages are counted per host. A host's bad rate gets a beta prior
centred on its registered domain's posterior mean, the domain's prior is centred on its
suffix's, and the suffix's on the overall rate. How strongly a level pulls (the prior's
weight in observations) is fitted by moments: the more the units of a level differ
beyond binomial noise, the weaker. A page is blocked if the lower posterior bound of its
host's bad rate, the mean less ``z`` posterior standard deviations, exceeds a limit.
Hosts without labels have their domain's posterior mean under the host prior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import stored

# host, path, verdict
Rule = tuple[str, str, str]

# Suffixes of two labels under which names are registered. Fixed values; extend by parameter.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "com.br", "co.nz", "co.in", "com.cn", "co.kr", "co.za")
# Prior weights stay within these bounds; without spread to measure, the upper one holds.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The last label, or the last two where those are a listed suffix."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*two_label), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The suffix and one label before it."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*two_label), F.substring_index(host, ".", -3)).otherwise(last_two)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or NULL.

    Rules are compared one by one, longest first: meant for lists of some hundreds.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        answer = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, answer).otherwise(found)
    return found


def _weight(units: DataFrame, rate: str) -> float:
    """How many observations the prior of a level counts for, by moments.

    With bad rate ``p`` of unit ``i`` around its prior mean ``m``, ``(p - m)^2`` is on
    average ``m (1 - m) (1 + (n - 1) r) / n``, where ``r = 1 / (weight + 1)``. Summed
    over units of two labels or more, weighted by ``n``, that gives ``r``.
    """
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col(rate), F.lit(2.0))
    noise = F.col(rate) * (1 - F.col(rate))
    # whole millionths, so that the sum does not depend on the order of rows
    total = lambda c: F.sum(F.floor(c * 1_000_000).cast("decimal(38,0)"))
    row = units.filter("n > 1").agg(total(spread - noise).alias("over"), total(noise * (F.col("n") - 1)).alias("room")).first()
    if not row["over"] or not row["room"] or row["over"] <= 0:
        return MOST_WEIGHT
    r = float(row["over"]) / float(row["room"])
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, 1 / r - 1))


def _posterior(units: DataFrame, prior: str, weight: float) -> Column:
    return (F.col("bad") + F.col(prior) * weight) / (F.col("n") + weight)


def reputations(pages: DataFrame, outcomes: DataFrame, page_col: str = "page_id", two_label: Sequence[str] = TWO_LABEL_SUFFIXES, z: float = 1.645) -> DataFrame:
    """``host``, ``n``, ``bad``, ``mean`` and ``lower`` of every distinct host in ``pages``.

    ``pages`` has ``host`` and the page id; ``outcomes`` has the page id and a boolean
    ``bad``. Counts are aggregated per host before anything else is joined, so a host
    with a third of all pages is one row. A page labelled more than once is bad if any
    label says so.
    """
    votes = outcomes.filter(F.col(page_col).isNotNull() & F.col("bad").isNotNull()).groupBy(page_col).agg(F.max("bad").alias("bad"))
    labelled = pages.select(page_col, "host").join(votes, page_col, "left")
    hosts = labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
    )
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), two_label)).withColumn("suffix", suffix_of(F.col("host"), two_label))
    hosts = stored(hosts, "url-hosts")
    summed = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    overall = hosts.agg(*summed).first()
    rate = (overall["bad"] + 1) / (overall["n"] + 2) if overall["n"] else 0.5
    suffixes = stored(hosts.groupBy("suffix").agg(*summed).withColumn("prior", F.lit(rate)), "url-suffixes")
    suffix_means = suffixes.select("suffix", _posterior(suffixes, "prior", _weight(suffixes, "prior")).alias("prior"))
    domains = stored(hosts.groupBy("suffix", "domain").agg(*summed).join(suffix_means, "suffix"), "url-domains")
    domain_means = domains.select("domain", _posterior(domains, "prior", _weight(domains, "prior")).alias("prior"))
    shrunk = stored(hosts.join(domain_means, "domain"), "url-shrunk")
    weight = _weight(shrunk, "prior")
    mean = _posterior(shrunk, "prior", weight)
    sd = F.sqrt(mean * (1 - mean) / (F.col("n") + weight + 1))
    return shrunk.select("host", "n", "bad", mean.alias("mean"), F.greatest(mean - z * sd, F.lit(0.0)).alias("lower"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = (),
    page_col: str = "page_id",
    url_col: str = "url",
    limit: float = 0.5,
    z: float = 1.645,
    two_label: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (NULL without one),
    ``verdict`` (``allow`` or ``block``), and ``lower``, the bound it was judged by.

    A NULL url, or one without ``://``, has an empty host, which is judged by its own
    labels like any other host. Repeated rows give a row each.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(page_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    votes = outcomes.select(F.col(page_col).alias("page_id"), "bad")
    known = reputations(parsed, votes, "page_id", two_label, z).select("host", "lower")
    joined = parsed.join(known, "host", "left")
    ruled = joined.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", learned).alias("verdict"), "lower")
