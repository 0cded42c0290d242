"""URL filters: rules for hosts and paths, then the reputation of hosts by empirical Bayes.

Labelled pages of a host are draws from its share of bad pages. That share has a
beta prior whose mean is the posterior mean of the host's registered domain, the
domain's one that of its public suffix, and the suffix's one the share of all
labelled pages; how much a level varies about the level above (the prior's weight) is
fitted by the moments of beta-binomial counts. A host goes if the lower bound of
its posterior, so many standard deviations below the mean, is over a limit: few
labels can't condemn a host, and a host without labels rests on its domain.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import materialise, table
from tessella.operators.joins import spread_join


class Rule(NamedTuple):
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules of the query (fixed values).
RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: A host goes if its share of bad pages is over LIMIT but for a chance of about 5 in 100 (1.645 standard deviations).
LIMIT, DEVIATIONS = 0.3, 1.645
#: Labels before a country that belong to the suffix, as in co.uk (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bounds of the correlation of two pages of a host that the moments may give.
LEAST_RHO, MOST_RHO = 0.001, 0.9


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null url or one without ``://``."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(u)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (of equally long ones a blocking one); null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def site_levels(host: Column) -> tuple[Column, Column, Column]:
    """Site (host without user and port), registered domain and suffix of a host.

    The suffix is the last label, or two where a country follows one of
    ``SECOND_LEVEL``; an address of numbers is its own domain and suffix.
    """
    site = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    site = F.rtrim(site, F.lit("."))
    labels = F.split(site, r"\.", -1)
    n = F.size(labels)
    two = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n >= 2, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    numbers = site.rlike(r"^[0-9.]*$|:")
    last = F.when(two, 2).otherwise(1)

    def tail(k: Column) -> Column:
        return F.when(numbers, site).otherwise(F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), "."))

    return site, tail(last + 1), tail(last)


def overdispersion(counts: DataFrame, mean: str = "prior_mean") -> float:
    """Weight of the prior (labels it is worth) from the counts (n, bad) of a level and the means above them.

    A beta-binomial count has the variance n m (1 - m) (1 + (n - 1) rho); the sums
    over all counts give rho, and 1 / rho - 1 is the weight.
    """
    n, b, m = (F.col(c).cast("double") for c in ("n", "bad", mean))
    plain = n * m * (1 - m)
    r = counts.agg(F.sum((b - n * m) ** 2).alias("seen"), F.sum(plain).alias("plain"), F.sum(plain * (n - 1)).alias("more")).head()
    if not r.more:
        return 1 / LEAST_RHO - 1
    return 1 / min(max((r.seen - r.plain) / r.more, LEAST_RHO), MOST_RHO) - 1


def posterior(rows: DataFrame, weight: float) -> DataFrame:
    """Add mean and weight of the posterior of (n, bad) under a prior of the mean ``prior_mean``."""
    total = F.col("n") + F.lit(weight)
    return rows.withColumns({"mean": (F.col("prior_mean") * weight + F.col("bad")) / total, "weight": total})


def page_outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, is_bad) from ``labels`` (doc_id, quality, toxic): an id's outcome is bad if any of its rows says toxic or no quality.

    Rows without an id, or with neither label, give none.
    """
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    return known.groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(bad).alias("is_bad"))


def bad_sites(urls: DataFrame, outcomes: DataFrame, limit: float = LIMIT, deviations: float = DEVIATIONS) -> DataFrame:
    """(site, n, bad, mean, bound) of the sites whose lower bound is over ``limit``.

    ``urls`` has page_id and host, ``outcomes`` (page_id, is_bad) one row for each
    labelled id. Rows are counted by (page_id, host) and by site before they are
    joined, so a hot host moves as partial counts.
    """
    each = urls.groupBy("page_id", "host").agg(F.count(F.lit(1)).alias("rows"))
    known = spread_join(each, outcomes, "page_id")
    site, domain, suffix = site_levels(F.col("host"))
    sites = known.groupBy(site.alias("site"), domain.alias("domain"), suffix.alias("suffix")).agg(
        F.sum(F.when(F.col("is_bad").isNotNull(), F.col("rows")).otherwise(0)).alias("n"), F.sum(F.when(F.col("is_bad") == 1, F.col("rows")).otherwise(0)).alias("bad")
    )
    sites = materialise(sites.where("site <> ''"), "url-sites")
    whole = sites.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).head()
    if not whole.n:
        return sites.select("site", "n", "bad", F.lit(0.0).alias("mean"), F.lit(0.0).alias("bound")).limit(0)
    above = (whole.bad + 0.5) / (whole.n + 1)

    def counts(*keys: str) -> DataFrame:
        return sites.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = counts("suffix").withColumn("prior_mean", F.lit(above))
    suffixes = materialise(posterior(suffixes, overdispersion(suffixes)).select("suffix", F.col("mean").alias("prior_mean")), "url-suffixes")
    domains = spread_join(counts("domain", "suffix"), suffixes, "suffix", "inner")
    domains = materialise(posterior(domains, overdispersion(domains)).select("domain", F.col("mean").alias("prior_mean")), "url-domains")
    hosts = spread_join(sites, domains, "domain", "inner")
    hosts = posterior(hosts, overdispersion(hosts))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return hosts.withColumn("bound", F.col("mean") - deviations * spread).where(F.col("bound") > limit).select("site", "n", "bad", "mean", "bound")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, limit: float = LIMIT, deviations: float = DEVIATIONS) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every row of ``pages`` (page_id, url).

    Without a rule, the verdict is block where the site's posterior bound of its
    share of bad pages is over ``limit``. A url that is null or has no ``://`` has an empty host and path,
    fits no rule and is allowed. Repeated rows are judged alike, one by one, and
    count one by one; a null page_id has no label. Without labels nothing is
    blocked but by rules. Empty tables give an empty result; other columns are not read.
    """
    host, path = url_parts("url")
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    bad = materialise(bad_sites(urls, page_outcomes(labels), limit, deviations).select("site", F.lit(True).alias("is_out")), "url-bad-sites")
    judged = urls.withColumns({"rule": rule, "ruled": verdict, "site": site_levels(F.col("host"))[0]})
    judged = spread_join(judged, bad, "site")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("is_out"), "block"), F.lit("allow")).alias("verdict"))


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    """``judge_urls`` over all ``pages``; a page's outcome is the row of ``labels`` with its id (the tables know no other)."""
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def _level(name: str, key: str, above: str) -> str:
    """SQL of one level: its prior's weight from the moments, then its posterior; ``above`` has n, bad and prior_mean by key."""
    return f"""{name}_w AS (SELECT 1 / least(greatest(CASE WHEN more > 0 THEN (seen - plain) / more ELSE {LEAST_RHO} END, {LEAST_RHO}), {MOST_RHO}) - 1 AS w FROM (SELECT sum((bad - n * prior_mean) ** 2) AS seen, sum(n * prior_mean * (1 - prior_mean)) AS plain, sum(n * prior_mean * (1 - prior_mean) * (n - 1)) AS more FROM {above})),
{name} AS (SELECT {key}, (prior_mean * w + bad) / (n + w) AS mean, n + w AS weight FROM {above}, {name}_w)"""


OP11_SQL = rf"""WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
r AS (SELECT page_id, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
q AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
s AS (SELECT *, rtrim(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS site FROM q),
l AS (SELECT *, string_split(site, '.') AS labels, regexp_matches(site, '^[0-9.]*$|:') AS numbers FROM s),
k AS (SELECT *, CASE WHEN len(labels) >= 3 AND length(labels[-1]) = 2 AND labels[-2] IN {SECOND_LEVEL} THEN 2 ELSE 1 END AS last FROM l),
t AS (SELECT page_id, host, path, site, CASE WHEN numbers THEN site ELSE array_to_string(labels[-last - 1:], '.') END AS domain, CASE WHEN numbers THEN site ELSE array_to_string(labels[-last:], '.') END AS suffix FROM k),
o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS is_bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
c AS (SELECT site, domain, suffix, count(is_bad) AS n, coalesce(sum(is_bad), 0) AS bad FROM t LEFT JOIN o USING (page_id) WHERE site <> '' GROUP BY 1, 2, 3),
g AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS prior_mean FROM c),
sc AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(prior_mean) AS prior_mean FROM c, g GROUP BY 1), {_level("su", "suffix", "sc")},
dc AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS prior_mean FROM c JOIN su USING (suffix) GROUP BY 1, 2), {_level("du", "domain", "dc")},
hc AS (SELECT site, n, bad, mean AS prior_mean FROM c JOIN du USING (domain)), {_level("hu", "site", "hc")},
b AS (SELECT site FROM hu WHERE mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (weight + 1)) > {LIMIT}),
ru AS (SELECT * FROM (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}) v(action, rhost, rpath)),
m AS (SELECT page_id, host, path, site, rhost || rpath AS rule, action, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k FROM (SELECT DISTINCT page_id, host, path, site FROM t) LEFT JOIN ru ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT t.page_id, t.host, t.path, m.rule, coalesce(m.action, CASE WHEN t.site IN (SELECT site FROM b) THEN 'block' END, 'allow') AS verdict
FROM t JOIN m ON m.page_id IS NOT DISTINCT FROM t.page_id AND m.host = t.host AND m.path = t.path AND m.k = 1"""
