"""URL filter: fixed rules first, then an empirical-Bayes reputation of hosts [native].

Labelled page outcomes (good or bad) are counted per host, registered domain
and suffix. Each level's rate is a beta-binomial posterior whose prior mean is
the posterior mean of the level above (suffix: of all pages) and whose strength
is estimated from how much the rates at that level differ (the ANOVA estimate
of the intraclass correlation). A url is blocked when the lower posterior bound
of its host's bad rate is over ``block_above``. A host without labels takes its
domain's, suffix's or the overall rate as its prior.

Nulls: a null url, or one without ``://``, has an empty host and path, fits no
rule and gets the method's verdict from the overall rate. Pages without a label
count towards nothing. A page labelled twice counts as bad if one label says so.
Repeated urls are judged alike, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.skew import salted_join

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Suffixes of two labels; others have one. Fixed values, a parameter.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_ABOVE, Z, STRENGTH = 0.5, 1.645, (2.0, 200.0)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, r"^(?s:.*?)://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def suffix_domain(host: Column) -> tuple[Column, Column]:
    labels = F.split(host, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    two = last(2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(two, last(2)).otherwise(last(1)), F.when(two, last(3)).otherwise(last(2))


def _strength(groups: DataFrame, n: str, bad: str) -> float:
    """Prior observations, from the spread of the groups' rates."""
    r = groups.where(F.col(n) > 0).agg(
        F.count(F.lit(1)).alias("g"), F.sum(n).alias("n"), F.sum(bad).alias("b"),
        F.sum(F.col(n) * F.col(n)).alias("nn"), F.sum(F.col(bad) * F.col(bad) / F.col(n)).alias("bb")).first()
    if not r["g"] or r["g"] < 2 or r["n"] <= r["g"]:
        return STRENGTH[1]
    m = r["b"] / r["n"]
    between = (r["bb"] - r["n"] * m * m) / (r["g"] - 1)
    within = (r["b"] - r["bb"]) / (r["n"] - r["g"])
    n0 = (r["n"] - r["nn"] / r["n"]) / (r["g"] - 1)
    rho = (between - within) / (between + (n0 - 1) * within) if between > within else 0.0
    return min(max(1 / rho - 1, STRENGTH[0]), STRENGTH[1]) if rho > 0 else STRENGTH[1]


def reputation(pages: DataFrame) -> DataFrame:
    """(host, pages, rate, bound): posterior mean and lower bound of each
    host's bad rate. ``pages``: host, bad (0, 1 or null). One pass over the
    pages; the rest works on one row per host, domain or suffix."""
    suffix, domain = suffix_domain(F.col("host"))
    hosts = (pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count("bad").alias("n"), F.sum(F.coalesce("bad", F.lit(0))).alias("b"))
                  .withColumn("suffix", suffix).withColumn("domain", domain).checkpoint())
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("b").alias("db"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb"))
    total = suffixes.agg(F.sum("sn").alias("n"), F.sum("sb").alias("b")).first()
    ks, kd, kh = _strength(suffixes, "sn", "sb"), _strength(domains, "dn", "db"), _strength(hosts, "n", "b")
    base = F.lit((total["b"] + 1) / (total["n"] + 2) if total["n"] else 0.5)
    mean = lambda bad, n, prior, k: (bad + prior * k) / (n + k)
    suffixes = suffixes.select("suffix", mean(F.col("sb"), F.col("sn"), base, ks).alias("prior_d"))
    domains = domains.join(suffixes, "suffix").select("domain", mean(F.col("db"), F.col("dn"), F.col("prior_d"), kd).alias("prior_h"))
    rate = mean(F.col("b"), F.col("n"), F.col("prior_h"), kh)
    return hosts.join(domains, "domain").select(
        "host", "pages", rate.alias("rate"), (rate - Z * F.sqrt(rate * (1 - rate) / (F.col("n") + kh + 1))).alias("bound"))


def judge(pages: DataFrame, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """Adds host, path, rule and verdict to pages with ``url`` and ``bad``.
    Other columns go along; those of the four names are replaced."""
    host, path = host_path(F.col("url"))
    new = ("host", "path", "rule", "verdict")
    p = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in new]).alias("_page"), "bad", host.alias("host"), path.alias("path"))
    rep = reputation(p.select("host", "bad")).checkpoint()
    p = salted_join(p, rep.select("host", "rate", "bound"), "host", rep.select("host", F.col("pages").alias("n")))
    p = p.withColumn("_r", rule_of(F.col("host"), F.col("path")))
    verdict = F.coalesce(F.col("_r.verdict"), F.when(F.col("bound") > block_above, "block").otherwise("allow"))
    return p.select("_page.*", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))
