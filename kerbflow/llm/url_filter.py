"""URL filters: host reputation from labelled pages, shrunk from host to registered domain to suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.registry import query, table
from kerbflow.session import store

#: Rules by host and path.
ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]
#: Second labels below which names are registered, as in `co.uk`.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]

#: A host is allowed if its share of good pages is at least LEAST_GOOD with the certainty of Z standard deviations.
LEAST_GOOD, Z = 0.5, 1.645
#: Pages that a prior counts for where the data say nothing of how much units differ.
DEFAULT_STRENGTH, LEAST_STRENGTH, MOST_STRENGTH = 10.0, 1.0, 10_000.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the last two labels, or three below a known second label of a country; no port or user."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    deep = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n >= 2, -2).otherwise(-1)).isin(SECOND_LEVEL)
    return F.when(name.rlike(r"^[0-9.]+$"), name).otherwise(F.array_join(F.slice(labels, F.greatest(F.lit(1), n - F.when(deep, 2).otherwise(1)), n), "."))


def suffix_of(domain: Column) -> Column:
    return F.regexp_replace(domain, r"^[^.]*\.", "")


def _rule(host: Column, path: Column, allow: list[str], block: list[str]) -> tuple[Column, Column]:
    """The longest rule that fits, and what it says; both null where none fits. The list of rules is part of the plan."""
    rule = verdict = F.lit(None).cast("string")
    for text in sorted({*allow, *block}, key=lambda r: (len(r), r)):  # the last condition set comes first
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, "block" if text in block else "allow").otherwise(verdict)
    return rule, verdict


def _strength(counts: DataFrame, unit: str) -> float:
    """Pages that the prior of a level counts for, by the method of moments over the units of the level.

    One row of sums comes back. The more the units differ beyond chance, the less their prior counts.
    """
    n, k = F.col("n"), F.col("good")
    units = counts.groupBy(unit).agg(F.sum("n").cast("double").alias("n"), F.sum("good").cast("double").alias("good"))
    s = units.where(n > 0).agg(F.count("*").alias("units"), F.sum(n).alias("n"), F.sum(k).alias("k"), F.sum(k * k / n).alias("kk"),
                               F.sum(n * n).alias("nn")).first()
    if not s.units or s.units < 2:
        return DEFAULT_STRENGTH
    p = s.k / s.n
    chance = p * (1 - p)
    room = chance * (s.n - s.nn / s.n - (s.units - 1))
    if room <= 0:
        return DEFAULT_STRENGTH
    between = (s.kk - s.k * s.k / s.n - chance * (s.units - 1)) / room
    return MOST_STRENGTH if between <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / min(between, 1.0) - 1))


def host_reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, good_share, bound) for every host of `hosts` from outcomes (host, good), where good is 1 or 0.

    A beta prior goes down the levels: all pages, suffix, registered domain, host. Each level shrinks its own counts to
    the posterior mean of the level above; `bound` is the posterior mean less Z standard deviations. Outcomes without a
    value do not count; a host without outcomes has the posterior of its domain.
    """
    named = outcomes.where(F.col("good").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good"))
    named = store(named.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain"))), "host-counts")
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    everywhere = (total.good + 1.0) / (total.n + 2.0)
    by = {level: _strength(named, level) for level in ("suffix", "domain", "host")}

    def below(counts: DataFrame, level: str, above: Column) -> DataFrame:
        s = by[level]
        n, good = F.coalesce(F.col("n"), F.lit(0)), F.coalesce(F.col("good"), F.lit(0))
        return counts.withColumn("a", above * s + good).withColumn("b", (1 - above) * s + n - good)

    counted = lambda level: named.groupBy(level).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    places = hosts.select("host").distinct().withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    suffixes = below(places.select("suffix").distinct().join(counted("suffix"), "suffix", "left"), "suffix", F.lit(everywhere))
    domains = below(places.select("domain", "suffix").distinct().join(counted("domain"), "domain", "left")
                    .join(suffixes.select("suffix", mean.alias("above")), "suffix"), "domain", F.col("above"))
    each = below(places.join(named.select("host", "n", "good"), "host", "left")
                 .join(domains.select("domain", mean.alias("above")), "domain"), "host", F.col("above"))
    total_weight = F.col("a") + F.col("b")
    return each.select("host", F.coalesce("n", F.lit(0)).alias("n"), mean.alias("good_share"),
                       (mean - Z * F.sqrt(F.col("a") * F.col("b") / (total_weight * total_weight * (total_weight + 1)))).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, allow: list[str], block: list[str], keep: list[str], url: str = "url") -> DataFrame:
    """The `keep` columns, host, path, the longest rule that fits, and the verdict: the rule's, else by host reputation.

    Outcomes have columns (url, good). A null url and one without `://` have an empty host and path; the empty host has a
    reputation of its own like any other. Repeated rows are judged alike. The reputation has one row per host; it is
    joined by host, where a host with a large share of the pages is split by adaptive execution.
    """
    placed = pages.select(*keep, host_of(F.col(url).cast("string")).alias("host"), path_of(F.col(url).cast("string")).alias("path"))
    labelled = outcomes.select(host_of(F.col("url").cast("string")).alias("host"), "good")
    known = store(host_reputation(placed, labelled), "host-reputation")
    rule, says = _rule(F.col("host"), F.col("path"), allow, block)
    return (placed.join(known.select("host", "bound"), "host", "left")
            .select(*keep, "host", "path", rule.alias("rule"),
                    F.coalesce(says, F.when(F.col("bound") >= LEAST_GOOD, "allow").otherwise("block")).alias("verdict")))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, good) of labelled pages: the number in a url's path names the document that the page shows."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), r"/([0-9]{1,18})(?:[^0-9/][^/]*)?/?$", 1)
    shown = pages.select("url", F.when(number != "", number).cast("bigint").alias("doc_id"))
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)).alias("good"))
    return shown.join(judged, "doc_id").select("url", "good")


_LEVEL_SQL = """
{l}_u as (select {l}, cast(sum(n) as double) n, cast(sum(good) as double) good from named group by {l}),
{l}_m as (select count(*) units, sum(n) n, sum(good) k, sum(good * good / n) kk, sum(n * n) nn from {l}_u),
{l}_v as (select *, k / n * (1 - k / n) chance from {l}_m),
{l}_w as (select *, chance * (n - nn / n - (units - 1)) room, kk - k * k / n - chance * (units - 1) above_chance from {l}_v),
{l}_s as (select case when units is null or units < 2 or not (room > 0) then 10.0::double when above_chance <= 0 then 10000.0::double
  else least(10000.0::double, greatest(1.0::double, 1 / least(above_chance / room, 1.0::double) - 1)) end s from {l}_w),
"""

OP1_SQL = r"""
with p as (select page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) path from pages),
o as (select host, good from (select host, try_cast(regexp_extract(path, '/([0-9]{1,18})(?:[^0-9/][^/]*)?/?$', 1) as bigint) doc_id from p)
  join (select doc_id, min(case when quality = 1 and toxic = 0 then 1 else 0 end) good from labels group by doc_id) using (doc_id)),
places as (select host, domain, regexp_replace(domain, '^[^.]*\.', '') suffix from (select host, case when name ~ '[0-9.]+' then name
    else array_to_string(l[greatest(1, len(l) - case when len(l) >= 3 and length(l[-1]) = 2 and l[-2] in
      ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') then 2 else 1 end):], '.') end domain
  from (select host, name, string_split(name, '.') l from (select distinct host,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as name from p)))),
named as (select host, domain, suffix, count(*) n, sum(good) good from o join places using (host) group by all),
""" + "".join(_LEVEL_SQL.format(l=level) for level in ("suffix", "domain", "host")) + r"""
g as (select (coalesce(sum(good), 0) + 1.0::double) / (coalesce(sum(n), 0) + 2.0::double) m from named),
sm as (select suffix, (m * s + coalesce(good, 0)) / (s + coalesce(n, 0)) m from (select distinct suffix from places)
  left join suffix_u using (suffix), suffix_s, g),
dm as (select domain, (m * s + coalesce(good, 0)) / (s + coalesce(n, 0)) m from (select distinct domain, suffix from places)
  left join domain_u using (domain) join sm using (suffix), domain_s),
hm as (select host, m * s + coalesce(good, 0) a, (1 - m) * s + coalesce(n, 0) - coalesce(good, 0) b from places
  left join host_u using (host) join dm using (domain), host_s),
j as (select page_id, host, path, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) bound,
  case when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
       when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
       when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
       when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
       when (host = 'org' or host like '%.org') and path like '/%' then 'org/' end rule
  from p join hm using (host))
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
  when bound >= 0.5 then 'allow' else 'block' end verdict from j
"""


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), ALLOW, BLOCK, ["page_id"])
