"""URL filtering by rules and by an empirical-Bayes reputation of hosts.

Labelled pages make a host's outcomes: how many were seen, how many were good. A host with few is
shrunk towards its registered domain, the domain towards its suffix, the suffix towards all pages.
How strongly is read off the table itself: at each level the spread of the children's shares around
their parents, beyond what binomial noise explains, gives the prior's weight (method of moments of
the beta-binomial). A host is allowed if the lower bound of its beta posterior reaches a threshold.
Aggregates and joins on hosts only; pages are counted before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.llm.common import lower_ascii
from opinara.staging import stage

# Fixed value: second-level labels under which names are registered in two-letter suffixes.
SECOND_LEVEL = "ac|co|com|edu|gov|net|org"


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class ReputationConfig:
    rules: tuple[UrlRule, ...] = field(default=RULES)
    #: A host's share of good pages has to reach this, at its lower bound.
    min_good: float = 0.65
    #: Standard deviations from the posterior's mean to its bound.
    z: float = 1.645
    #: Bounds of a prior's weight in pages.
    least_weight: float = 2.0
    most_weight: float = 1000.0


def host_of(url: str = "url") -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The public suffix of a host without user and port; empty for an address of numbers."""
    name = F.regexp_extract(host, r"([^@:]*)(?::[0-9]*)?$", 1)
    last = F.regexp_extract(name, rf"((?:^|(?<=\.))(?:{SECOND_LEVEL})\.[a-z]{{2}}|[^.]*)$", 1)
    return F.when(name.rlike(r"^[0-9.]+$"), F.lit("")).otherwise(last)


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label more; an address is its own."""
    name = F.regexp_extract(host, r"([^@:]*)(?::[0-9]*)?$", 1)
    domain = F.regexp_extract(name, rf"((?:[^.]*\.)?(?:(?<=\.)(?:{SECOND_LEVEL})\.[a-z]{{2}}|[^.]*))$", 1)
    return F.when(name.rlike(r"^[0-9.]+$"), name).otherwise(domain)


def longest_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits, else null."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        action = F.when(fits, F.lit(rule.action)).otherwise(action)
    return name, action


def _prior_weight(children: DataFrame, config: ReputationConfig) -> float:
    """Weight of the prior, in pages, from ``n, good`` of children and ``mean`` of their parents."""
    v = F.col("mean") * (1 - F.col("mean"))
    spread, noise, reach = children.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mean"), 2)), F.sum(v), F.sum(v * (F.col("n") - 1))
    ).first()
    if not reach or spread <= noise:
        return config.most_weight
    alike = min(1.0, (spread - noise) / reach)
    return min(config.most_weight, max(config.least_weight, 1 / alike - 1))


def reputations(outcomes: DataFrame, config: ReputationConfig) -> DataFrame:
    """``host, posterior, bound`` of ``(host, n, good)``, a row per host; null if nothing is labelled."""
    hosts = stage(
        outcomes.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts"
    )
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    n, good = hosts.agg(*sums).first()
    if not n:
        return hosts.select("host", F.lit(None).cast("double").alias("posterior"), F.lit(None).cast("double").alias("bound"))
    share = (F.col("good") / F.col("n")).alias("mean")

    def shrunk(children: DataFrame, weight: float) -> Column:
        return (F.col("good") + weight * F.col("prior")) / (F.col("n") + weight)

    top = suffixes.withColumn("mean", F.lit(good / n)).withColumn("prior", F.lit(good / n))
    suffix_means = top.withColumn("m", shrunk(top, _prior_weight(top, config)))
    below = domains.join(suffixes.where("n > 0").select("suffix", share), "suffix", "left")
    w = _prior_weight(below, config)
    domain_means = domains.join(suffix_means.select("suffix", F.col("m").alias("prior")), "suffix")
    domain_means = domain_means.withColumn("m", shrunk(domain_means, w))
    below = hosts.join(domains.where("n > 0").select("domain", "suffix", share), ["domain", "suffix"], "left")
    w = _prior_weight(below, config)
    ready = hosts.join(domain_means.select("domain", "suffix", F.col("m").alias("prior")), ["domain", "suffix"])
    mean = shrunk(ready, w)
    bound = F.col("posterior") - config.z * F.sqrt(F.col("posterior") * (1 - F.col("posterior")) / (F.col("n") + w + 1))
    return stage(ready.withColumn("posterior", mean).withColumn("bound", bound).select("host", "posterior", "bound"), "reputations")


def judge_urls(pages: DataFrame, outcomes: DataFrame, config: ReputationConfig = ReputationConfig()) -> DataFrame:
    """A row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``outcomes`` has ``host, n, good`` (labelled pages, good ones), a row per host at most; hosts
    without any take their domain's reputation. A null url, or one without ``://``, has an empty
    host and path, and is judged as that host. If nothing is labelled, what no rule decides is
    allowed. Repeated rows are judged alike; an empty table gives no rows; other columns are
    ignored.
    """
    parsed = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    seen = parsed.groupBy("host").count().select("host")
    known = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    counts = seen.join(known, "host", "full").na.fill(0, ["n", "good"])
    rule, action = longest_rule(F.col("host"), F.col("path"), config.rules)
    method = F.when(F.coalesce(F.col("bound"), F.lit(1.0)) >= config.min_good, "allow").otherwise("block")
    joined = parsed.join(reputations(counts, config), "host", "left")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, method).alias("verdict"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, n, good`` of the pages whose document (the number in the path) is labelled.

    A page is good if its document is of good quality and not toxic.
    """
    number = F.regexp_extract(path_of(), r"/([0-9]{1,18})(?:[^0-9/][^/]*)?/?$", 1)
    doc = F.when(number != "", number.cast("long"))
    counted = pages.select(host_of().alias("host"), doc.alias("doc_id")).where("doc_id is not null")
    counted = counted.groupBy("host", "doc_id").agg(F.count("*").alias("pages"))
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("marks"),
        F.sum(((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("long")).alias("good_marks"),
    )
    return counted.join(known, "doc_id").groupBy("host").agg(
        F.sum(F.col("pages") * F.col("marks")).alias("n"), F.sum(F.col("pages") * F.col("good_marks")).alias("good")
    )


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_urls(pages, page_outcomes(pages, labels))


OP6_SQL = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
marks AS (SELECT doc_id, count(*) AS marks, count(*) FILTER (WHERE quality = 1 AND coalesce(toxic, 0) = 0) AS good
          FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
numbered AS (SELECT host, try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})([^0-9/][^/]*)?/?$', 1), '') AS BIGINT) AS doc_id FROM parsed),
outcomes AS (SELECT host, sum(marks) AS n, sum(good) AS good FROM numbered JOIN marks USING (doc_id) GROUP BY host),
hosts AS (
  SELECT host, coalesce(n, 0)::DOUBLE AS n, coalesce(good, 0)::DOUBLE AS good,
         string_split(regexp_extract(host, '([^@:]*)(:[0-9]*)?$', 1), '.') AS l
  FROM (SELECT DISTINCT host FROM parsed) LEFT JOIN outcomes USING (host)),
cut AS (
  SELECT *, CASE WHEN regexp_matches(array_to_string(l, '.'), '^[0-9.]+$') THEN 0
                 WHEN len(l) > 1 AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') AND regexp_matches(l[-1], '^[a-z]{2}$') THEN 2
                 ELSE 1 END AS k FROM hosts),
named AS (
  SELECT host, n, good, CASE k WHEN 0 THEN array_to_string(l, '.') ELSE array_to_string(l[-(k + 1):], '.') END AS domain,
         CASE k WHEN 0 THEN '' ELSE array_to_string(l[-k:], '.') END AS suffix FROM cut),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM named GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM named GROUP BY ALL),
total AS (SELECT sum(n) AS n, sum(good) / nullif(sum(n), 0) AS mean FROM named),
children AS (
  SELECT 0 AS level, s.n, s.good, t.mean FROM suffixes s, total t
  UNION ALL SELECT 1, d.n, d.good, s.good / nullif(s.n, 0) FROM domains d JOIN suffixes s USING (suffix)
  UNION ALL SELECT 2, h.n, h.good, d.good / nullif(d.n, 0) FROM named h JOIN domains d USING (domain, suffix)),
moments AS (
  SELECT level, sum(n * (good / n - mean) ** 2) AS spread, sum(mean * (1 - mean)) AS noise, sum(mean * (1 - mean) * (n - 1)) AS reach
  FROM children WHERE n > 0 GROUP BY level),
weights AS (
  SELECT level, CASE WHEN coalesce(reach, 0) = 0 OR spread <= noise THEN 1000.0
                     ELSE least(1000.0, greatest(2.0, 1 / least(1.0, (spread - noise) / reach) - 1)) END AS w FROM moments),
m0 AS (SELECT suffix, (s.good + w * t.mean) / (s.n + w) AS m FROM suffixes s, total t, weights WHERE level = 0),
m1 AS (SELECT domain, suffix, (d.good + w * m) / (d.n + w) AS m FROM domains d JOIN m0 USING (suffix), weights WHERE level = 1),
m2 AS (SELECT host, (h.good + w * m) / (h.n + w) AS m, h.n + w AS mass FROM named h JOIN m1 USING (domain, suffix), weights WHERE level = 2),
rules(name, rhost, rpath, action) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
fitting AS (
  SELECT host, path, arg_max(name, length(name)) AS rule, arg_max(action, length(name)) AS action
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN coalesce(m - 1.645 * sqrt(m * (1 - m) / (mass + 1)), 1) >= 0.65 THEN 'allow' ELSE 'block' END) AS verdict
FROM parsed LEFT JOIN m2 USING (host) LEFT JOIN fitting USING (host, path)
"""
