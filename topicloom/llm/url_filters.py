"""URL rules and host reputation, with DataFrame functions only.

A rule names a host with its subdomains and the start of a path; the longest rule
that fits decides. Where none fits, the reputation of the host does: labelled page
outcomes are shrunk through beta-binomial priors from suffix to registered domain to
host, and a host is blocked when the lower posterior bound of its share of bad pages
is above a limit. A host without labels inherits the belief about its domain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two labels under which domains are registered; a parameter.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz")
STRENGTH = (1e-4, 0.999)


def host_of(url: Column) -> Column:
    """From the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(list(two_label)), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(list(two_label)), F.substring_index(host, ".", -3)).otherwise(two)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest fitting rule, else null. Rules: (verdict, 'host/path')."""
    chain = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, slash, start = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + start)
        hit = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        chain = F.when(fits, hit) if chain is None else chain.when(fits, hit)
    return chain if chain is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def _strength(children: DataFrame) -> float:
    """Prior observations that the spread of the children around their prior implies.

    ``children`` has n, bad and mu (the prior mean). The intraclass correlation r of
    a beta-binomial follows from its second moment; the strength is 1/r - 1.
    """
    spread = F.pow(F.col("bad") - F.col("n") * F.col("mu"), 2) / F.col("n")
    noise = F.col("mu") * (1 - F.col("mu"))
    over, room = children.where("n > 0").agg(
        F.coalesce(F.sum(spread - noise), F.lit(0.0)),
        F.coalesce(F.sum(noise * (F.col("n") - 1)), F.lit(0.0))).first()
    r = over / room if room > 0 else 0.0
    return 1 / min(max(r, STRENGTH[0]), STRENGTH[1]) - 1


def host_reputation(outcomes: DataFrame, confidence: float = 1.645,
                    two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, n, bad, mean, bound) for every host of ``outcomes`` (host, bad).

    ``bad`` is 1, 0 or null for an unlabelled page. ``bound`` is the mean less
    ``confidence`` posterior standard deviations, at least 0. Outcomes are summed per
    host before they move; the levels above read one row per host.
    """
    hosts = cut(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(
        F.sum("bad"), F.lit(0)).alias("bad")).withColumns({
            "domain": domain_of(F.col("host"), two_label),
            "suffix": suffix_of(F.col("host"), two_label)}), "hosts")
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()

    def sums(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(level: DataFrame, out: str) -> DataFrame:
        m = _strength(level)
        return level.withColumn(out, (F.col("bad") + m * F.col("mu")) / (F.col("n") + m))

    suffixes = shrunk(sums("suffix").withColumn("mu", F.lit((bad + 0.5) / (n + 1.0))), "mu_suffix")
    domains = shrunk(sums("domain", "suffix").join(
        suffixes.select("suffix", F.col("mu_suffix").alias("mu")), "suffix"), "mu_domain")
    leaves = hosts.join(domains.select("domain", F.col("mu_domain").alias("mu")), "domain")
    m = _strength(leaves)
    a = F.col("bad") + m * F.col("mu")
    b = F.col("n") - F.col("bad") + m * (1 - F.col("mu"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return leaves.select("host", "n", "bad", (a / (a + b)).alias("mean"),
                         F.greatest(a / (a + b) - confidence * sd, F.lit(0.0)).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]],
               limit: float = 0.5, confidence: float = 1.645, key: str = "page_id",
               url: str = "url", salts: int = 16) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, mean, bound.

    ``outcomes`` has (key, bad). A key that repeats there counts as bad if any of its
    rows is. Pages without a host share the empty host. Pages meet the reputation of
    their host in ``salts`` parts, so a host with a third of all pages is spread.
    """
    u = F.col(url).cast("string")
    rows = pages.select(F.col(key).alias("key"), host_of(u).alias("host"), path_of(u).alias("path"))
    known = outcomes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max("bad").cast("bigint").alias("bad"))
    hosts = cut(host_reputation(rows.join(known, "key", "left"), confidence), "reputation")
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    judged = (rows.withColumn("salt", F.pmod(F.xxhash64("key", "path"), F.lit(salts)).cast("int"))
              .join(hosts.select("host", "mean", "bound", parts.alias("salt")), ["host", "salt"]))
    hit = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("hit", hit)
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return judged.select(F.col("key").alias(key), "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce(F.col("hit.verdict"), by_host).alias("verdict"), "mean",
                         "bound")
