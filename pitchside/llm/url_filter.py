"""URL filter: hierarchical empirical-Bayes host reputation.

Labelled page outcomes are counted per host. A host's bad rate is shrunk through
a chain of beta-binomial priors: the corpus rate is the prior of each public
suffix, the suffix's posterior mean the prior of its registered domains, the
domain's posterior mean the prior of its hosts. The prior strength of each level
is the moment estimate from the spread of the rates below it. A host is blocked
where the lower bound of its posterior bad rate exceeds ``lift`` times the corpus rate (held
between ``least_limit`` and ``most_limit``): it is then surely much worse than the corpus,
whatever share of it is bad. Where hosts do not differ by more than chance, none is. Explicit
rules come first. Everything is DataFrame expressions.

Edge cases: a null url, or one without ``://``, has empty host and path, no rule
and no reputation, and is allowed. Hosts without labelled pages take the prior of
their domain, suffix or corpus. No labels at all: everything that no rule blocks
is allowed. A label that is null, or unknown because one of its parts is, is no outcome. Repeated rows count
as often as they occur. Very long urls are read whole by expressions. Of rules that fit, the
longest wins, and of equally long ones the last in text order. Only the named columns
are read, so extra columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import stored

# (host, path prefix, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# second-level public suffixes under which the registered domain has three labels
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "co.nz", "com.br", "com.cn", "co.in", "co.kr", "co.za")


@dataclass(frozen=True)
class Reputation:
    lift: float = 2.0  # blocked where the posterior lower bound is above so many corpus rates ...
    least_limit: float = 0.05
    most_limit: float = 0.9
    z: float = 1.645  # normal bound, 95 % one-sided
    least_strength: float = 1.0  # of a prior, in pages
    most_strength: float = 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lowered; path: on to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def split_pages(pages: DataFrame) -> DataFrame:
    """page_id, host, path, domain, suffix of every page."""
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    name = F.regexp_replace(F.regexp_replace(F.col("host"), r"^.*@", ""), r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    wide = two.isin(*TWO_LABEL_SUFFIXES)
    return p.select(
        "page_id", "host", "path",
        F.when(wide, F.substring_index(name, ".", -3)).otherwise(two).alias("domain"),
        F.when(wide, two).otherwise(F.substring_index(name, ".", -1)).alias("suffix"),
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # the longest is applied last
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame, conf: Reputation) -> tuple[float, float]:
    """(mean, strength) of the beta prior over the groups' rates, by moments. One row
    of sums reaches the driver."""
    g = groups.where("n > 0")
    tot = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not tot["n"]:
        return 0.0, conf.most_strength
    k, n, mean = tot["k"], tot["n"], tot["bad"] / tot["n"]
    noise = mean * (1 - mean)
    spread = g.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.lit(mean), F.lit(2.0))).alias("s")).first()["s"] / n
    if noise <= 0 or n <= k:
        return mean, conf.most_strength
    rho = (spread - noise * (k - 1) / n) / (noise * (1 - k / n))
    strength = conf.most_strength if rho <= 0 else (1 - rho) / rho
    return mean, min(max(strength, conf.least_strength), conf.most_strength)


def reputations(counts: DataFrame, conf: Reputation = Reputation()) -> DataFrame:
    """(host, domain, suffix, n, bad) to the posterior of each host: rate, lower bound, and the
    limit that the corpus sets."""
    suffixes = counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = counts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    mean, s_suffix = _strength(suffixes, conf)
    _, s_domain = _strength(domains, conf)
    _, s_host = _strength(counts, conf)
    post = lambda prior, s: (F.lit(s) * prior + F.col("bad")) / (F.lit(s) + F.col("n"))
    suffix_rate = suffixes.select("suffix", post(F.lit(mean), s_suffix).alias("suffix_rate"))
    domain_rate = domains.join(suffix_rate, "suffix").select("suffix", "domain", post(F.col("suffix_rate"), s_domain).alias("domain_rate"))
    a = F.lit(s_host) * F.col("domain_rate") + F.col("bad")
    total = F.lit(s_host) + F.col("n")
    rate = a / total
    sd = F.sqrt(rate * (1 - rate) / (total + 1))
    return (
        counts.join(domain_rate, ["suffix", "domain"])
        .withColumns({"rate": rate, "lower": F.round(rate - F.lit(conf.z) * sd, 9)})
        .withColumn("limit", F.lit(min(conf.most_limit, max(conf.least_limit, conf.lift * mean))))
        .select("host", "n", "bad", "rate", "lower", "limit")
    )


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, conf: Reputation = Reputation()) -> DataFrame:
    """``pages`` (page_id, url) judged by rules and host reputation.

    ``outcomes``: (page_id, bad 0/1), labelled pages. Page rows are counted per
    host and outcome before anything is exchanged, so a host with a third of all
    pages is a few partial counts.
    """
    parts = split_pages(pages)
    bad = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    seen = parts.groupBy("page_id", "host", "domain", "suffix").agg(F.count(F.lit(1)).alias("times"))
    counts = stored(
        seen.join(bad, "page_id", "left")
        .groupBy("host", "domain", "suffix")
        .agg(F.sum(F.when(F.col("bad").isNotNull(), F.col("times")).otherwise(0)).alias("n"), F.sum(F.coalesce(F.col("bad") * F.col("times"), F.lit(0))).alias("bad")),
        "url_counts",
    )
    rep = reputations(counts, conf)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_method = F.when((F.col("host") != "") & (F.col("lower") > F.col("limit")), F.lit("block")).otherwise(F.lit("allow"))
    return parts.select("page_id", "host", "path").join(rep, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), F.col("lower").alias("bad_rate_bound"),
    )


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged. A page's outcome is the label of the document whose number
    is the first number of its path (the page is that document's web form); bad: low
    quality or toxic."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, path = host_and_path(F.col("url"))
    number = F.expr("try_cast(ref AS BIGINT)")
    refs = pages.select("page_id", F.regexp_extract(path, r"/([0-9]{1,18})", 1).alias("ref")).select("page_id", number.alias("doc_id"))
    bad = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    outcomes = refs.where("doc_id IS NOT NULL").join(bad, "doc_id").select("page_id", "bad")
    return filter_urls(pages.select("page_id", "url"), outcomes)


OP5_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), named AS (
  SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS ls,
    regexp_extract(path, '/([0-9]{1,18})', 1) AS ref FROM parts
), levels AS (
  SELECT page_id, host, path, try_cast(ref AS BIGINT) AS doc_id, array_to_string(ls[-2:], '.') IN (__SUFFIXES__) AS wide, ls FROM named
), p AS (
  SELECT page_id, host, path, doc_id, array_to_string(CASE WHEN wide THEN ls[-3:] ELSE ls[-2:] END, '.') AS domain,
    array_to_string(CASE WHEN wide THEN ls[-2:] ELSE ls[-1:] END, '.') AS suffix FROM levels
), lab AS (
  SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INT)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), out AS (SELECT page_id, max(bad) AS bad FROM p JOIN lab USING (doc_id) WHERE page_id IS NOT NULL AND bad IS NOT NULL GROUP BY page_id),
h AS (SELECT host, domain, suffix, count(o.bad) AS n, coalesce(sum(o.bad), 0) AS bad FROM p LEFT JOIN out o USING (page_id) GROUP BY ALL),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
lv AS (SELECT 'h' AS lv, n, bad FROM h UNION ALL SELECT 'd', n, bad FROM d UNION ALL SELECT 's', n, bad FROM s),
tot AS (SELECT lv, count(*) AS k, sum(n) AS n, sum(bad) / sum(n) AS mean FROM lv WHERE n > 0 GROUP BY lv),
mom AS (SELECT lv, any_value(t.k) AS k, any_value(t.n) AS n, any_value(t.mean) AS mean,
   sum(x.n * pow(x.bad / x.n - t.mean, 2)) / any_value(t.n) AS spread FROM lv x JOIN tot t USING (lv) WHERE x.n > 0 GROUP BY lv),
rho AS (SELECT *, CASE WHEN mean * (1 - mean) <= 0 OR n <= k THEN -1 ELSE (spread - mean * (1 - mean) * (k - 1) / n) / (mean * (1 - mean) * (1 - k / n)) END AS r FROM mom),
st AS (SELECT lv, mean, CASE WHEN r <= 0 THEN 1000.0 ELSE least(greatest((1 - r) / r, 1.0), 1000.0) END AS m FROM rho),
sr AS (SELECT suffix, (m * mean + bad) / (m + n) AS sr FROM s, st WHERE lv = 's'),
dr AS (SELECT suffix, domain, (m * sr + bad) / (m + n) AS dr FROM d JOIN sr USING (suffix), st WHERE lv = 'd'),
hr AS (SELECT host, (m * dr + bad) / (m + n) AS rate, m + n AS total FROM h JOIN dr USING (suffix, domain), st WHERE lv = 'h'),
rep AS (SELECT host, round(rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)), 9) AS lower FROM hr),
ruled AS (SELECT p.page_id, p.host, p.path, rep.lower,
  CASE WHEN (p.host = 'example.com' OR p.host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (p.host = 'example.net' OR p.host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (p.host = 'org' OR p.host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (p.host = 'net' OR p.host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p LEFT JOIN rep ON p.host = rep.host)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN host <> '' AND lower > (SELECT least(0.9, greatest(0.05, 2 * mean)) FROM tot WHERE lv = 's') THEN 'block' ELSE 'allow' END AS verdict, lower AS bad_rate_bound
FROM ruled
""".replace("__SUFFIXES__", ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES))
