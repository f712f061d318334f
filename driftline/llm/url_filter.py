"""URL filters with empirical-Bayes host reputation, DataFrame functions only.

Listed rules (host, path) judge the urls they fit: the host or any subdomain of it, a path that
starts with the rule's; the longest rule wins. Rules are a table of any size: a url is spelt out into
the domains above its host and, for those that have rules, into the beginnings of its path of the
lengths that occur there, and meets its rules by equality of both. Their verdicts are the labelled
outcomes (block = 1) from which the reputation of every other page is learnt: outcomes are counted
per host by one grouped aggregate, summed to registered domains and suffixes, and every rate is
shrunk through a beta-binomial prior towards the level above it: host to domain to suffix to the
whole table. The prior strength of each level is estimated from the spread of its rates (method of
moments). A page is blocked when the lower bound of its host's posterior block rate exceeds LIMIT.

Cases: a null url, or one without "://", has empty host and path, fits no rule and is judged by the
prior of the empty host; repeated rows are judged each (and counted each); a table without
any fitting rule has no outcomes: all are allowed; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.hosts import host_levels, host_suffixes
from driftline.llm.text import ascii_lower

# (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
LIMIT = 0.5
Z = 1.0  # posterior standard deviations below the mean
STRENGTH = (1.0, 1000.0)  # bounds of an estimated prior strength


def url_parts(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return (ascii_lower(F.regexp_extract(u, "://([^/?#]*)", 1)), F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1))


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, ruled) of the longest rule that fits each of ``urls`` (host, path; distinct), for
    those that any fits; of equally long ones the first by text. ``rules`` has verdict, host, path."""
    own = rules.select(F.col("host").alias("h"), F.col("path").alias("p"), "verdict").filter("h IS NOT NULL AND p IS NOT NULL")
    own = own.groupBy("h", "p").agg(F.min("verdict").alias("verdict"))
    lengths = own.groupBy("h").agg(F.collect_set(F.length("p")).alias("lengths"))  # at most as many as a path has characters
    spelt = urls.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("h")).join(lengths, "h")
    spelt = spelt.select("host", "path", "h", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    fits = spelt.withColumn("p", F.expr("left(path, n)")).join(own, ["h", "p"])
    size = (F.length("h") + F.length("p")).alias("size")
    best = fits.groupBy("host", "path").agg(F.min(F.struct((-size).alias("s"), F.concat("h", "p").alias("rule"), "verdict")).alias("b"))
    return best.select("host", "path", "b.rule", F.col("b.verdict").alias("ruled"))


def _strength() -> Column:
    """Prior strength of a level, over the outcomes n, k of its groups: rho is the moment estimate of
    the correlation inside a group; strength is 1 / rho - 1."""
    n, k = F.sum("n"), F.sum("k")
    p = k / n
    # sum of n (k/n - p)^2 = sum of k^2/n - p * sum of k
    spread = F.sum(F.col("k") * F.col("k") / F.col("n")) - p * k
    g = F.count("*")
    free = n - F.sum(F.col("n") * F.col("n")) / n - (g - 1)
    rho = (spread / (p * (1 - p)) - (g - 1)) / F.nullif(free, F.lit(0.0))
    low, high = STRENGTH
    strength = F.when((p > 0) & (p < 1) & (free > 0), F.when(rho <= 0, F.lit(high)).otherwise(
        F.least(F.greatest(1 / rho - 1, F.lit(low)), F.lit(high)))).otherwise(F.lit(high))
    return strength.alias("strength")


def reputation(labelled: DataFrame) -> DataFrame:
    """(host, n, k, rate, low): ``labelled`` has host and block (1, 0, or null for a page without
    outcome). One row per host. n, k: outcomes and blocks; rate and low: posterior mean and
    lower bound."""
    hosts = labelled.groupBy("host").agg(F.count("block").alias("n"), F.coalesce(F.sum("block"), F.lit(0)).cast("bigint").alias("k"))
    domain, suffix = host_levels(F.col("host"))
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    # strengths of the three levels and the overall rate: one row, beside every row of a table
    one = F.lit(1).alias("_one")
    top = suffixes.agg(*sums).select(one, ((F.col("k") + 0.5) / (F.col("n") + 1)).alias("p0"))
    for name, groups in (("ms", suffixes), ("md", domains), ("mh", hosts)):
        top = top.join(groups.filter("n > 0").agg(_strength()).select(one, F.col("strength").alias(name)), "_one")

    def shrunk(n: str, k: str, prior: str, strength: str) -> Column:
        return (F.col(k) + F.col(strength) * F.col(prior)) / (F.col(n) + F.col(strength))

    suf = suffixes.withColumn("_one", F.lit(1)).join(F.broadcast(top), "_one")
    suf = suf.select("suffix", shrunk("n", "k", "p0", "ms").alias("ps"), "md", "mh")
    dom = domains.join(suf, "suffix").select("domain", shrunk("n", "k", "ps", "md").alias("pd"), "mh")
    out = hosts.join(dom, "domain").withColumn("rate", shrunk("n", "k", "pd", "mh"))
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("mh") + 1))
    return out.select("host", "n", "k", "rate", (F.col("rate") - Z * sd).alias("low"))


def judge_urls(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages`` (needs page_id, url): page_id, host, path, rule, verdict, and
    rate and low of the host. ``rules``: (verdict, host, path), as a table or a list."""
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(list(rules), "verdict string, host string, path string")
    host, path = url_parts(F.col("url"))
    df = pages.select("page_id", host.alias("host"), path.alias("path"))
    df = df.join(matched_rules(df.select("host", "path").distinct(), rules), ["host", "path"], "left")
    block = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    known = reputation(df.select("host", block.alias("block")))
    df = df.join(known.select("host", "rate", "low"), "host")
    learnt = F.when(F.col("low") > LIMIT, "block").otherwise("allow")
    return df.select("page_id", "host", "path", "rule", F.coalesce("ruled", learnt).alias("verdict"), "rate", "low")
