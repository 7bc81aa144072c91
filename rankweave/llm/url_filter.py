"""URL filters (operator 8), in built-in SQL functions alone: fixed rules, then an empirical-Bayes host reputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Labels of second-level public suffixes, under which names are registered one level deeper (fixed values).
SECOND_LEVEL = ("co", "com", "net", "org", "gov", "ac", "edu")
#: Prior strength, in pages, where a level has too few groups to estimate it.
STRENGTH = 20.0
#: Standard deviations between the posterior mean and its lower bound; pages are blocked if that bound exceeds BAD.
Z, BAD = 1.64, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for texts without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, pattern, 1), UPPER, LOWER), F.regexp_extract(whole, pattern, 2)


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; an address of numbers and a single label are their own."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    deep = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.get(parts, n - 2).isin(*SECOND_LEVEL)
    number = host.rlike(r"^[0-9.]+$|:")
    take = F.when(deep, 3).otherwise(2)
    domain = F.when(number | (n < 2), host).otherwise(F.array_join(F.slice(parts, F.greatest(n - take + 1, F.lit(1)), take), "."))
    suffix = F.when(number | (n < 2), host).when(deep, F.array_join(F.slice(parts, n - 1, 2), ".")).otherwise(F.element_at(parts, -1))
    return domain, suffix


def _strength(groups: DataFrame, group: str) -> DataFrame:
    """One row: the beta prior's strength that fits the spread of a level's rates, by moments over groups of two pages or more."""
    rate = F.col("bad") / F.col("n")
    many = groups.where("n >= 2")
    fit = many.agg(
        F.count("*").alias("g"),
        (F.sum("bad") / F.sum("n")).alias("p"),
        F.var_samp(rate).alias("v"),
        F.avg(1 / F.col("n")).alias("w"),
    )
    spread = F.col("p") * (1 - F.col("p"))
    between = F.greatest(F.col("v") - spread * F.col("w"), spread / 1000)
    fitted = F.least(F.greatest(spread / between - 1, F.lit(2.0)), F.lit(1000.0))
    usable = (F.col("g") >= 3) & (spread > 0) & F.col("v").isNotNull()
    return fit.select(F.when(usable, fitted).otherwise(STRENGTH).alias(f"k_{group}"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``host, n, bad, mean, bound`` from labelled pages ``(host, bad)``: a beta-binomial posterior of each host's share of bad pages.

    A suffix shrinks towards all pages, a registered domain towards its suffix and a
    host towards its domain; each level's prior strength comes from the spread of
    its own rates. ``bound`` is the posterior mean less Z standard deviations. Pages
    are counted per host first, so that a hot host is one row afterwards.
    """
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = levels(F.col("host"))
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = suffixes.agg((F.sum("bad") / F.sum("n")).alias("p_all"))
    one = top.crossJoin(_strength(suffixes, "suffix")).crossJoin(_strength(domains, "domain")).crossJoin(_strength(hosts, "host"))

    def shrunk(prior: str, k: str) -> Column:
        return (F.col("bad") + F.col(k) * F.col(prior)) / (F.col("n") + F.col(k))

    one = F.broadcast(one)  # a single row
    p_suffix = suffixes.crossJoin(one).select("suffix", "k_domain", "k_host", shrunk("p_all", "k_suffix").alias("p_suffix"))
    p_domain = domains.join(p_suffix, "suffix").select("domain", "suffix", "k_host", shrunk("p_suffix", "k_domain").alias("p_domain"))
    found = hosts.join(p_domain, ["domain", "suffix"])
    a = F.col("bad") + F.col("k_host") * F.col("p_domain")
    total = F.col("n") + F.col("k_host")
    mean = a / total
    bound = mean - Z * F.sqrt(mean * (1 - mean) / (total + 1))
    return found.select("host", "n", "bad", mean.alias("mean"), bound.alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, host_bound`` of every page.

    The longest rule that fits decides. Else a host whose posterior bound exceeds
    BAD is blocked, and every other page is allowed, pages of unlabelled hosts
    included. ``outcomes(page_id, bad)`` labels some pages; null outcomes don't
    count, nor do labels of unknown pages. Null urls have an empty host and path.
    """
    host, path = split_url(F.col("url"))
    split = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    labelled = split.join(outcomes.where("bad is not null").select("page_id", "bad"), "page_id").select("host", "bad")
    known = host_reputation(labelled).select("host", F.col("bound").alias("host_bound"))
    rule = verdict = None
    for what, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == name) | F.endswith(F.col("host"), F.lit(f".{name}"))) & F.startswith(F.col("path"), F.lit(start))
        rule = F.when(fits, name + start) if rule is None else rule.when(fits, name + start)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    by_host = F.when(F.col("host_bound") > BAD, "block").otherwise("allow")
    return split.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), "host_bound"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long").alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), bad).select("page_id", "host", "path", "rule", "verdict")


_SQL = f"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
parts AS (
  SELECT *, string_split(host, '.') AS p, len(string_split(host, '.')) AS k,
    regexp_matches(host, '^[0-9.]+$|:') AS num FROM split),
deep AS (
  SELECT *, k >= 3 AND length(p[-1]) = 2 AND p[k - 1] IN ({", ".join(f"'{s}'" for s in SECOND_LEVEL)}) AS d FROM parts),
named AS (
  SELECT page_id, host, path,
    CASE WHEN num OR k < 2 THEN host WHEN d THEN array_to_string(p[k-2:k], '.') ELSE array_to_string(p[k-1:k], '.') END AS domain,
    CASE WHEN num OR k < 2 THEN host WHEN d THEN array_to_string(p[k-1:k], '.') ELSE p[-1] END AS suffix
  FROM deep),
out AS (
  SELECT n.*, CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL OR toxic IS NULL THEN NULL ELSE 0 END AS bad
  FROM named n JOIN labels l ON l.doc_id = n.page_id),
h AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM out WHERE bad IS NOT NULL GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
fit AS (
  SELECT lev, count(*) AS g, sum(bad) / sum(n) AS p, var_samp(bad / n) AS v, avg(1 / n) AS w
  FROM (SELECT 'h' AS lev, n, bad FROM h UNION ALL SELECT 'd', n, bad FROM d UNION ALL SELECT 's', n, bad FROM s)
  WHERE n >= 2 GROUP BY lev),
k AS (
  SELECT lev, CASE WHEN g >= 3 AND p * (1 - p) > 0 AND v IS NOT NULL
    THEN least(greatest(p * (1 - p) / greatest(v - p * (1 - p) * w, p * (1 - p) / 1000) - 1, 2.0), 1000.0) ELSE {STRENGTH} END AS k
  FROM fit),
one AS (
  SELECT (SELECT sum(bad) / sum(n) FROM s) AS p_all,
    coalesce((SELECT k FROM k WHERE lev = 's'), {STRENGTH}) AS ks,
    coalesce((SELECT k FROM k WHERE lev = 'd'), {STRENGTH}) AS kd,
    coalesce((SELECT k FROM k WHERE lev = 'h'), {STRENGTH}) AS kh),
ps AS (SELECT suffix, (bad + ks * p_all) / (n + ks) AS p FROM s, one),
pd AS (SELECT domain, d.suffix, (bad + kd * ps.p) / (n + kd) AS p FROM d JOIN ps USING (suffix), one),
post AS (SELECT host, (h.bad + kh * pd.p) / (h.n + kh) AS mean, h.n + kh AS total FROM h JOIN pd USING (domain, suffix), one),
rep AS (SELECT host, mean - {Z} * sqrt(mean * (1 - mean) / (total + 1)) AS bound FROM post),
ruled AS (
  SELECT n.page_id, n.host, n.path, bound,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM named n LEFT JOIN rep USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN bound > {BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

QUERIES = {"op8_url_filter": op8_url_filter}
ORACLE_SQL = {"op8_url_filter": _SQL}
