"""URL filter: rules first, then the reputation of the page's host.

Reputation is an empirical-Bayes estimate of the share of good pages. Labelled
pages are counted by host, registered domain and suffix. Each level is shrunk
towards the one above through a beta prior: its mean is the estimate above, its
strength comes from how much the groups of that level differ beyond chance. A
page is allowed if the lower bound of its host's posterior is high enough.

Built-in expressions only. Pages are counted by host before anything else, so a
host with a third of all pages is one row per task in every shuffle; the join
that hands out the verdicts is one that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import LOWER, UPPER, lower_ascii, stage, table

# Fixed values of the contract: (verdict, host, start of the path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# registries' suffixes of two labels.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr",
            "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
PORT, ADDRESS = r":[0-9]*$", r"^([0-9.]+|\[.*)$"
DEVIATIONS = 1.645
LEAST_GOOD = 0.5
# Strength of a prior: at least as much as two pages, at most ten thousand.
WEAKEST, STRONGEST = 2.0, 10_000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def strength(groups: DataFrame, mean: Column) -> DataFrame:
    """One row: pages that a prior at this level is worth, by the moments of (n, good)."""
    sums = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("groups"),
                      F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)).alias("spread"),
                      F.max(mean * (1 - mean)).alias("chance"))
    extra = (F.col("spread") - (F.col("groups") - 1) * F.col("chance")) / F.nullif(
        F.col("n") - F.col("nn") / F.col("n"), F.lit(0.0))
    share = F.greatest(extra, F.lit(0.0)) / F.nullif(F.col("chance"), F.lit(0.0))
    worth = F.when(share > 0, (1 - share) / share).otherwise(STRONGEST)
    return sums.select(F.greatest(F.least(F.coalesce(worth, F.lit(STRONGEST)), F.lit(STRONGEST)), F.lit(WEAKEST)).alias("worth"))


def domain_parts(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host. Its port is no part of them; an address is a domain of its own."""
    name = F.regexp_replace(host, PORT, "")
    labels = F.split(name, r"\.")
    two = F.regexp_extract(name, r"[^.]*\.[^.]*$", 0)
    of_two = two.isin(*suffixes)
    address = name.rlike(ADDRESS)
    n = F.when(of_two, 3).otherwise(2)
    domain = F.when(address | (F.size(labels) <= n), name).otherwise(F.concat_ws(".", F.slice(labels, -n, n)))
    return domain, F.when(address, "").when(of_two, two).otherwise(F.element_at(labels, -1))


def reputation(labelled_hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, n, good, mean, bound) from rows (host, n, good), one for each host, n = 0 if unlabelled.

    A registered domain is the suffix and one label before it. Without any
    label the mean is 1/2. The three levels are staged, one row a group; the
    strengths of the priors are three numbers.
    """
    domain, suffix = domain_parts(F.col("host"), suffixes)
    hosts = stage(labelled_hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    add = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = stage(hosts.groupBy("domain", "suffix").agg(*add), "domains")
    tops = stage(domains.groupBy("suffix").agg(*add), "suffixes")
    sums = tops.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()

    def shrink(groups: DataFrame) -> DataFrame:
        """Mean and bound of the posterior of groups with n, good and prior."""
        worth = strength(groups.filter("n > 0"), F.col("prior")).first()["worth"]
        a = worth * F.col("prior") + F.col("good")
        b = worth * (1 - F.col("prior")) + F.col("n") - F.col("good")
        mean = a / (a + b)
        return groups.withColumn("mean", mean).withColumn(
            "bound", mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (a + b + 1)))

    top = shrink(tops.withColumn("prior", F.lit((sums["good"] + 1) / (sums["n"] + 2))))
    middle = shrink(domains.join(top.select("suffix", F.col("mean").alias("prior")), "suffix"))
    return shrink(hosts.join(middle.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"])).select(
        "host", "n", "good", "mean", "bound")


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          least_good: float = LEAST_GOOD) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's labelled pages, a row for each row of ``pages``.

    ``outcomes`` has (page_id, good 0 or 1); an id with two outcomes counts as
    the worse. A null or malformed url has an empty host, that is a host too. A
    null page_id has no outcome. Urls of any length are taken whole; only the named columns
    are read, so others may have any name.
    """
    host, path = url_parts(F.col("url"))
    known = pages.select("page_id", host.alias("host"), path.alias("path"))
    marks = outcomes.filter(F.col("page_id").isNotNull() & F.col("good").isNotNull()).groupBy("page_id").agg(
        F.min("good").cast("long").alias("good"))
    counts = known.join(marks, "page_id", "left").groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    known = known.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    return known.join(reputation(counts), "host").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("bound") >= least_good, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
        F.col("n").alias("host_labelled"), F.col("good").alias("host_good"))


def outcomes_of(labels: DataFrame) -> DataFrame:
    """The labels of pages: good is good quality and not toxic."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.select(F.col("doc_id").alias("page_id"), good.cast("int").alias("good"))


def op5_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"), outcomes_of(table(spark, folder, "labels")))


def _strength_sql(groups: str, mean: str) -> str:
    return f"""select greatest({WEAKEST}, least({STRONGEST}, coalesce(case when share > 0 then (1 - share) / share else {STRONGEST} end, {STRONGEST}))) as worth
  from (select greatest((spread - (groups - 1) * chance) / nullif(n - nn / n, 0), 0) / nullif(chance, 0) as share from (
    select sum(n)::double as n, sum(n * n)::double as nn, count(*) as groups,
      sum(n * pow(good::double / n - {mean}, 2)) as spread, max({mean} * (1 - {mean})) as chance
    from {groups} where n > 0))"""


def _shrunk_sql(groups: str, worth: str) -> str:
    return f"""select *, a / (a + b) as mean, a / (a + b) - {DEVIATIONS} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) as bound
  from (select *, worth * prior + good as a, worth * (1 - prior) + n - good as b from {groups}, {worth})"""


def _rule_sql(value: int) -> str:
    cases = "".join(f" when (host = '{h}' or suffix(host, '.{h}')) and prefix(path, '{p}') then '{(h + p, v)[value]}'"
                    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    return f"case{cases} end"


SQL = f"""with rests as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rests
), known as (
  select page_id, translate(raw, '{UPPER}', '{LOWER}') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from parts
), marks as (
  select doc_id as page_id, min(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 else 0 end) as good
  from labels where doc_id is not null group by doc_id
), hosts as (
  select host, count(good) as n, coalesce(sum(good), 0)::bigint as good,
    regexp_replace(host, '{PORT}', '') as name, string_split(name, '.') as labels,
    array_to_string(labels[-2:], '.') in {SUFFIXES} and len(labels) > 1 as of_two, regexp_matches(name, '{ADDRESS}') as address,
    case when address then '' when of_two then array_to_string(labels[-2:], '.') else labels[-1] end as suffix,
    case when address then name when of_two then array_to_string(labels[-3:], '.') else array_to_string(labels[-2:], '.') end as domain
  from known left join marks using (page_id) group by host
), domains as (select domain, suffix, sum(n)::bigint as n, sum(good)::bigint as good from hosts group by domain, suffix
), suffixes as (select suffix, sum(n)::bigint as n, sum(good)::bigint as good from domains group by suffix
), used1 as (select *, (select (sum(good) + 1)::double / (sum(n) + 2) from suffixes) as prior from suffixes
), worth1 as ({_strength_sql('used1', 'prior')}), top as ({_shrunk_sql('used1', 'worth1')}
), used2 as (select d.*, t.mean as prior from domains d join top t using (suffix)
), worth2 as ({_strength_sql('used2', 'prior')}), middle as ({_shrunk_sql('used2', 'worth2')}
), used3 as (select h.*, m.mean as prior from hosts h join middle m using (domain, suffix)
), worth3 as ({_strength_sql('used3', 'prior')}), final as ({_shrunk_sql('used3', 'worth3')})
select page_id, host, path, {_rule_sql(0)} as rule,
  coalesce({_rule_sql(1)}, case when bound >= {LEAST_GOOD} then 'allow' else 'block' end) as verdict,
  n as host_labelled, good as host_good
from known join final using (host)"""
