"""URL rules and empirical-Bayes host reputation, in column expressions only.

Hosts are judged by the labelled outcomes of their pages. A host with few labels says little,
so its share of bad pages is shrunk towards its registered domain, the domain's towards its
suffix and the suffix's towards all pages, each through a beta prior whose weight is estimated
from the spread between the units of that level (method of moments). A host is blocked when
even the lower bound of its posterior share of bad pages exceeds the limit. Explicit rules come
first.

Outcomes are counted with partial aggregation, so a host with a third of all pages is one row
per task before the shuffle, and host statistics join back to the pages by host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (verdict, host and path): fixed values of the query's contract.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# A host is blocked when its share of bad pages is over the limit even at this many posterior
# standard deviations below the mean.
BAD_SHARE = 0.2
DEVIATIONS = 1.645
# Suffixes of two labels under which domains are registered; all others have one label.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "co.in")
# Least and greatest weight of a prior, in pages.
LEAST_WEIGHT, GREATEST_WEIGHT = 1.0, 1000.0
MAX_RULES = 1_000


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a url; both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; of equally long ones the first by text."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; join longer lists as a table")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda one: (len(one[1]), one[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(two)


def prior_weight(units: DataFrame, parent: str) -> DataFrame:
    """One row with the weight (pages) of a level's prior.

    ``units`` has (bad, n, ``parent`` = the prior mean). With the variance between units beyond
    what counting alone explains, s = sum n (p - m)^2 - sum m (1 - m), the weight is
    sum n m (1 - m) / s - 1, within fixed limits; no extra variance gives the greatest weight.
    """
    m, n = F.col(parent), F.col("n")
    spread = F.sum(n * F.pow(F.col("bad") / n - m, F.lit(2.0)) - m * (1 - m))
    expected = F.sum(n * m * (1 - m))
    weight = F.when(spread > 0, expected / spread - 1).otherwise(GREATEST_WEIGHT)
    limited = F.least(F.greatest(weight, F.lit(LEAST_WEIGHT)), F.lit(GREATEST_WEIGHT))
    return units.where("n > 0").agg(F.coalesce(limited, F.lit(GREATEST_WEIGHT)).alias("weight"))


def shrunk(units: DataFrame, prior: str, name: str) -> DataFrame:
    """Add the posterior mean ``name`` of each unit and the ``weight`` behind its prior."""
    weighed = units.withColumn("weight", prior_weight(units, prior).scalar())
    mean = (F.col("bad") + F.col("weight") * F.col(prior)) / (F.col("n") + F.col("weight"))
    return weighed.withColumn(name, mean)


def reputation(outcomes: DataFrame, bad_share: float = BAD_SHARE, deviations: float = DEVIATIONS) -> DataFrame:
    """One row per host: (host, n, bad, mean, bound, blocked).

    ``outcomes`` has a row per page with ``host`` and ``bad`` (1, 0, or null for unlabelled).
    Hosts without labelled pages have their domain's share, wide bounds and are seldom blocked.
    """
    counted = [F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")]
    hosts = outcomes.groupBy("host").agg(*counted)
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    summed = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    overall = hosts.agg(*summed).select(F.expr("coalesce((bad + 0.5) / (n + 1), 0.5)").alias("base"))
    suffixes = hosts.groupBy("suffix").agg(*summed).withColumn("base", overall.scalar())
    suffixes = shrunk(suffixes, "base", "suffix_mean").select("suffix", "suffix_mean")
    domains = hosts.groupBy("domain", "suffix").agg(*summed).join(suffixes, "suffix")
    domains = shrunk(domains, "suffix_mean", "domain_mean").select("domain", "domain_mean")
    judged = shrunk(hosts.join(domains, "domain"), "domain_mean", "mean")
    size = F.col("n") + F.col("weight")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    bound = F.col("mean") - deviations * deviation
    return judged.select("host", "n", "bad", "mean", bound.alias("bound"), (bound > bad_share).alias("blocked"))


def judged_urls(pages: DataFrame, labels: DataFrame, rules=RULES, **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page.

    A labelled page has a label of its id; it is bad when its quality is 0 in any of them.
    Null urls and urls without ``://`` have an empty host, judged like any other. A null id is
    unlabelled; repeated pages are pages of their own; empty tables give an empty result.
    Other columns of both tables are not read.
    """
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    outcome = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").alias("page_id"))
    outcome = outcome.agg(F.max(1 - F.col("quality")).alias("bad"))
    verdicts = reputation(parsed.join(outcome, "page_id", "left"), **limits)
    rule, decision = matching_rule(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("blocked"), "block").otherwise("allow")
    return parsed.join(verdicts.select("host", "blocked"), "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, learnt).alias("verdict")
    )


_SUFFIX_LIST = ", ".join(f"'{suffix}'" for suffix in SECOND_LEVEL)


def _labels_of(host: str, count: int) -> str:
    """SQL for the last labels of a host."""
    return f"regexp_extract({host}, '([^.]*\\.){{0,{count - 1}}}[^.]*$')"


def _prior_sql(units: str, prior: str) -> str:
    spread = f"sum(n * power(bad / n - {prior}, 2.0) - {prior} * (1 - {prior}))"
    raw = f"case when {spread} > 0 then sum(n * {prior} * (1 - {prior})) / {spread} - 1 else {GREATEST_WEIGHT} end"
    return (
        f"select coalesce(least(greatest({raw}, {LEAST_WEIGHT}), {GREATEST_WEIGHT}), {GREATEST_WEIGHT}) as weight "
        f"from {units} where n > 0"
    )


def _rule_sql(column: str) -> str:
    cases = []
    for decision, text in sorted(RULES, key=lambda one: (-len(one[1]), one[1])):
        rule_host, slash, rule_path = text.partition("/")
        value = {"rule": text, "verdict": decision}[column]
        cases.append(
            f"when (host = '{rule_host}' or ends_with(host, '.{rule_host}')) "
            f"and starts_with(path, '{slash + rule_path}') then '{value}'"
        )
    return "case " + " ".join(cases) + " end"


SQL = rf"""
with parsed as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from (select page_id, case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end as rest from pages)
), outcome as (
  select doc_id, max(1 - quality) as bad from labels where quality in (0, 1) group by doc_id
), hosts as (
  select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as bad,
    case when {_labels_of("host", 2)} in ({_SUFFIX_LIST}) then {_labels_of("host", 3)} else {_labels_of("host", 2)} end as domain,
    case when {_labels_of("host", 2)} in ({_SUFFIX_LIST}) then {_labels_of("host", 2)} else {_labels_of("host", 1)} end as suffix
  from parsed left join outcome on doc_id = page_id group by host
), suffixes as (
  select suffix, sum(n) as n, sum(bad) as bad,
    (select coalesce((sum(bad) + 0.5) / (sum(n) + 1), 0.5) from hosts) as base from hosts group by suffix
), suffix_means as (
  select suffix, (bad + weight * base) / (n + weight) as suffix_mean from suffixes, ({_prior_sql("suffixes", "base")})
), domains as (
  select domain, suffix, sum(n) as n, sum(bad) as bad, any_value(suffix_mean) as suffix_mean
  from hosts join suffix_means using (suffix) group by domain, suffix
), domain_means as (
  select domain, (bad + weight * suffix_mean) / (n + weight) as domain_mean
  from domains, ({_prior_sql("domains", "suffix_mean")})
), placed as (
  select host, n, bad, domain_mean from hosts join domain_means using (domain)
), judged as (
  select host, (bad + weight * domain_mean) / (n + weight) as mean, n + weight as size
  from placed, ({_prior_sql("placed", "domain_mean")})
)
select page_id, host, path, {_rule_sql("rule")} as rule,
  coalesce({_rule_sql("verdict")},
    case when mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (size + 1)) > {BAD_SHARE} then 'block' else 'allow' end) as verdict
from parsed join judged using (host)
"""
