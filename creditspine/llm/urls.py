"""URL filter: fixed rules first, then the reputation of the host.

Rules name a host and the start of a path. A rule fits its host and all
subdomains; the longest fitting rule decides. Pages that no rule decides are
judged by labelled outcomes (good or bad) of pages, gathered per host,
registered domain and suffix. Each level's prior is a beta distribution round
the posterior mean of the level above, its strength fitted to the spread of the
rates at that level (method of moments, between ``weakest`` and ``strongest``);
the top prior is the share of bad pages overall. A page is blocked if even the
lower bound of its host's posterior bad rate, mean - z * deviation, is above
``block_above``.

The registered domain is the last two labels, or one more below a ``suffixes``
entry such as ``co.uk``; the suffix is the rest of it. A host without a dot is its
own domain and suffix.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and takes its verdict from the pages alike, if any, else from the overall
rate. Every row is judged, also repeated ones. An empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspine.llm.common import store

#: (verdict, host, start of the path)
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
SUFFIXES = ("co.uk", "com.au", "co.jp", "com.br")
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_text(rule: tuple[str, str, str]) -> str:
    return rule[1] + rule[2]


def matched_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: -len(rule_text(r))):
        fits = ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
        rule = F.when(fits, rule_text(r)) if rule is None else rule.when(fits, rule_text(r))
        verdict = F.when(fits, r[0]) if verdict is None else verdict.when(fits, r[0])
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def domain_of(host: Column, suffixes=SUFFIXES) -> Column:
    parts = F.split(host, r"\.")
    n = F.size(parts)
    two = F.concat_ws(".", F.slice(parts, F.greatest(n - 1, F.lit(1)), F.lit(2)))
    three = F.concat_ws(".", F.slice(parts, F.greatest(n - 2, F.lit(1)), F.lit(3)))
    return F.when(two.isin(*suffixes), three).otherwise(two)


def suffix_of(domain: Column) -> Column:
    """What follows the first label of a registered domain."""
    return F.when(domain.contains("."), F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1)).otherwise(domain)


def _strength(bad: Column, n: Column, mean: Column, weakest: float, strongest: float) -> Column:
    """Prior strength s that explains how rates of one level scatter round their means."""
    spread = F.sum(n * F.pow(bad / n - mean, 2)) / F.sum(n)
    chance = F.sum(mean * (1 - mean)) / F.sum(n)  # scatter from counting alone, a row per group
    base = F.sum(n * mean * (1 - mean)) / F.sum(n)
    extra = F.greatest(spread - chance, F.lit(1e-9))
    return F.coalesce(F.least(F.greatest(base / extra - 1, F.lit(weakest)), F.lit(strongest)), F.lit(strongest))


def reputation(outcomes: DataFrame, suffixes=SUFFIXES, weakest: float = 1.0, strongest: float = 1000.0) -> dict[str, DataFrame]:
    """Posterior (mean, weight) tables from (host, bad): ``host``, ``domain``, ``suffix`` and ``all``.

    Counts are summed per host before anything else, so a hot host is one row.
    """
    hosts = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("domain")))
    hosts = store(hosts)
    whole = hosts.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    # one bad and one good page before any is seen
    mean = (F.col("bad") + 1) / (F.col("n") + 2)
    out = {"all": store(whole.select(mean.alias("mean"), (F.col("n") + 2).cast("double").alias("weight")))}
    above = out["all"].select(F.col("mean").alias("up"))
    for level, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [level] if parent is None else [level, parent]
        sums = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        sums = sums.withColumn("up", F.lit(above.first()[0])) if parent is None else sums.join(above, parent)
        sums = store(sums)
        s = sums.agg(_strength(F.col("bad"), F.col("n"), F.col("up"), weakest, strongest)).first()[0]
        mean = (F.col("up") * s + F.col("bad")) / (s + F.col("n"))
        out[level] = store(sums.select(level, mean.alias("mean"), (F.col("n") + F.lit(s)).alias("weight"), F.lit(s).alias("strength")))
        above = out[level].select(level, F.col("mean").alias("up"))
    return out


def judge(pages: DataFrame, outcomes: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          rules=RULES, suffixes=SUFFIXES, block_above: float = 0.5, z: float = 1.0) -> DataFrame:
    """(id_col, host, path, rule, verdict, bad_rate, bad_bound) for every row.

    ``outcomes`` (host, bad 0 or 1) are labelled pages; without them the pages
    that a rule decides are the labelled ones: a blocked page is a bad outcome.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, ruled = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", ruled)
    if outcomes is None:
        outcomes = rows.where("ruled is not null").select("host", (F.col("ruled") == "block").cast("int").alias("bad"))
    known = reputation(outcomes, suffixes)
    # one row per host that occurs; the smallest level that has outcomes judges it
    hosts = rows.select("host").distinct().withColumn("domain", domain_of(F.col("host"), suffixes))
    hosts = hosts.withColumn("suffix", suffix_of(F.col("domain")))
    strength = {}
    for level in ("suffix", "domain", "host"):
        strength[level] = (known[level].select("strength").first() or [1000.0])[0]
        t = known[level].select(level, F.col("mean").alias(f"m_{level}"), F.col("weight").alias(f"w_{level}"))
        hosts = hosts.join(t, level, "left")
    top = known["all"].first()
    mean = F.coalesce("m_host", "m_domain", "m_suffix", F.lit(top["mean"]))
    # a host without outcomes has its prior alone: the mean above, at its level's strength
    weight = F.coalesce("w_host", F.lit(strength["host"]))
    bound = mean - z * F.sqrt(mean * (1 - mean) / (weight + 1))
    hosts = store(hosts.select("host", mean.alias("bad_rate"), bound.alias("bad_bound")))
    out = rows.join(hosts, "host")
    verdict = F.coalesce("ruled", F.when(F.col("bad_bound") > block_above, "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "bad_rate", "bad_bound")
