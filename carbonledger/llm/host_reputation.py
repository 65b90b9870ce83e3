"""URL filter: explicit rules first, else the empirical-Bayes reputation of the host.

Reputation.  A page has an outcome when ``labels`` marks it: bad if its quality
is 0 or it is toxic, else good.  Outcomes are counted per host, registered
domain and suffix, and each level's share of good pages is shrunk towards the
one above through a beta-binomial prior:

    suffix <- all pages,  domain <- suffix,  host <- domain:
    mean = (good + s * mean above) / (n + s)

The prior strength ``s`` of a level is estimated from all its groups by the
moments of the beta-binomial: with S = sum of n_g (p_g - p)^2 around the rate p
of the group above, E[S] = p (1 - p) [(1 - r)(G - 1) + r (N - sum n_g^2 / N)],
solved for the correlation r over all groups above together; s = (1 - r) / r,
kept within ``STRENGTH``.

Verdict.  A host's good share has the posterior Beta(good + s m, bad + s (1 - m)).
Its pages are blocked when even the upper bound mean + z sd is below
``threshold``: a host is filtered on evidence, an unknown one is let through
unless its domain or suffix is known to be bad.

Counts are partial aggregates by host, so a host with a third of all pages is a
row per task; the pages then meet only the table of blocked hosts.

Defined cases: a url that is null or has no ``://`` has an empty host and path
(all such pages share the reputation of the empty host); user names, ports and a
last dot do not count for the domain; addresses of digits or in brackets are
their own domain without a suffix; repeated label rows of a page are one outcome
(bad if any is bad), labels that are null in both columns are none; repeated
pages each count and each give a row; without any outcome the mean is one half
and nothing is blocked; empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: (verdict, rule): host and path prefix in one string.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Suffixes of two labels; every other suffix is the last label.
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
STRENGTH = (2.0, 1000.0)
DEFAULT_STRENGTH = 10.0  # where a level has no two groups to compare
Z, THRESHOLD = 1.645, 0.5

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Host of a url, A-Z lower-cased ('' without one)."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _SPLIT, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def fits(host: Column, path: Column, rule: str) -> Column:
    """The rule's host is the url's host or a parent of it, and the url's path starts with the rule's."""
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; of equal rules a block wins.

    The rules are a parameter of the plan, evaluated longest first in one expression.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[0] != "block"))
    none = F.lit(None).cast("string")
    rule = F.coalesce(*[F.when(fits(host, path, r), F.lit(r)) for _, r in ranked], none)
    verdict = F.coalesce(*[F.when(fits(host, path, r), F.lit(v)) for v, r in ranked], none)
    return rule, verdict


def registered_domain(host: Column) -> tuple[Column, Column]:
    """(domain, suffix) of a host."""
    bare = F.regexp_extract(host, r"(?s)^(?:.*@)?(.*?)\.?(?::[0-9]*)?$", 1)
    address = bare.rlike(r"^[0-9.]+$|^\[")
    two = F.substring_index(bare, ".", -2).isin(*TWO_LABELS)
    domain = F.when(address, bare).when(two, F.substring_index(bare, ".", -3)).otherwise(
        F.substring_index(bare, ".", -2))
    suffix = F.when(address, F.lit("")).when(two, F.substring_index(bare, ".", -2)).otherwise(
        F.substring_index(bare, ".", -1))
    return domain, suffix


def outcomes(labels: DataFrame) -> DataFrame:
    """(doc_id, good 0/1): one outcome for each labelled page."""
    low = F.when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 0)
    toxic = F.when(F.col("toxic") == 1, 1).when(F.col("toxic").isNotNull(), 0)
    bad = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.greatest(low, toxic)).alias("bad"))
    return bad.filter("bad IS NOT NULL").select("doc_id", (1 - F.col("bad")).alias("good"))


def host_counts(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, domain, suffix, n outcomes, good) of every host; ``urls``: page_id and host."""
    own = outcomes(labels).withColumnRenamed("doc_id", "page_id")
    domain, suffix = registered_domain(F.col("host"))
    counts = (urls.join(own, "page_id", "left").groupBy("host")
              .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")))
    return counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "good")


def prior_strength(groups: DataFrame, above: Sequence[str]) -> float:
    """Prior strength of a level whose ``groups`` (n, good) lie under the groups of the columns ``above``."""
    per = (groups.filter("n > 0").groupBy(*above)
           .agg(F.sum("n").cast("double").alias("t"), F.sum("good").cast("double").alias("k"),
                F.count(F.lit(1)).alias("g"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
                F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("k2")))
    p = F.col("k") / F.col("t")
    a = (F.col("k2") - F.col("k") * p) / (p * (1 - p)) - (F.col("g") - 1)
    b = F.col("t") - F.col("n2") / F.col("t") - (F.col("g") - 1)
    r = per.filter("k > 0 AND k < t").agg(F.sum(a), F.sum(b)).first()
    if r[1] is None or r[1] <= 1e-9:
        return DEFAULT_STRENGTH
    least, most = STRENGTH
    rho = min(max(r[0] / r[1], 1 / (1 + most)), 1 / (1 + least))
    return (1 - rho) / rho


def shrunk(level: DataFrame, strength: float, prior: Column, out: str) -> DataFrame:
    return level.withColumn(out, (F.col("good") + strength * prior) / (F.col("n") + strength))


def reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """(host, domain, suffix, n, good, mean, upper) of a materialised ``host_counts`` table."""
    sums = F.sum("n").alias("n"), F.sum("good").alias("good")
    domains = cut(hosts.groupBy("suffix", "domain").agg(*sums))
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(*sums).first()
    mean = ((total[1] or 0) + 1) / ((total[0] or 0) + 2)
    of_host = prior_strength(hosts, ["suffix", "domain"])
    of_domain = prior_strength(domains, ["suffix"])
    of_suffix = prior_strength(suffixes, [])
    top = shrunk(suffixes, of_suffix, F.lit(mean), "m_suffix").select("suffix", "m_suffix")
    mid = shrunk(domains.join(top, "suffix"), of_domain, F.col("m_suffix"), "m").select("suffix", "domain", "m")
    # Materialised, so that a domain with a large share of the hosts can be split in the join.
    both = hosts.join(cut(mid), ["suffix", "domain"])
    a, b = F.col("good") + of_host * F.col("m"), F.col("n") - F.col("good") + of_host * (1 - F.col("m"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return both.select("host", "domain", "suffix", "n", "good", (a / (a + b)).alias("mean"),
                       (a / (a + b) + z * sd).alias("upper"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, z: float = Z,
          threshold: float = THRESHOLD) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (allow or block), by_rule boolean."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    known = reputation(cut(host_counts(urls, labels)), z)
    blocked = cut(known.filter(F.col("upper") < threshold).select("host", F.lit("block").alias("__own")))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    return urls.join(blocked, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.col("__own"), F.lit("allow")).alias("verdict"), verdict.isNotNull().alias("by_rule"))
