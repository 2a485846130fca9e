"""URL filters: explicit rules, else empirical-Bayes host reputation.

Every host belongs to a registered domain, every domain to a public suffix.
Labelled outcomes of pages (1: bad) are counted per host, domain and suffix,
and the rates are shrunk downwards: the suffix towards the rate of all labelled
pages, the domain towards its suffix, the host towards its domain, each time by
the posterior of a beta-binomial model whose prior strength is estimated from
how much the rates of that level scatter (method of moments). A page is blocked
if the lower bound of its host's posterior bad rate (``Z`` deviations below the
mean) is over ``CUTOFF``.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A rule (host,
path) fits its host and all subdomains if the path starts with the rule's; the
longest rule wins and overrides the reputation.

Edge cases: null urls and urls without ``://`` have empty host and path and no
rule; they are judged by the reputation of the empty host. Without any label
nothing is blocked by reputation. Labels without an outcome or without a page
are ignored; a page that is repeated counts each time, as do repeated labels.
Rows without a page id are judged. An empty table gives an empty result;
further columns pass through, ones named like a result column are replaced.

At scale: the reputation reads ids and urls. Counts are partially aggregated;
posteriors are computed once per host, domain and suffix. Domains meet their
suffix, hosts their domain and pages their host through ``lookup``, which
broadcasts the few hot keys (a suffix like com, a domain with a host per user) and
shuffles the rest; pages are scanned twice for it and not written. The rules are
a hand-written list and become one expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_star.llm.common import lookup, materialise

Z = 1.645
CUTOFF = 0.5
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# public suffixes of two labels, a parameter; every other last label is a suffix
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "ne.jp", "com.br", "co.in", "co.kr", "co.nz", "com.cn", "com.mx", "co.za")
RESULT = ("host", "path", "rule", "verdict", "n_labelled", "bad_rate", "bad_bound")
KEY, WEIGHT = "of_host", "of_pages"  # of the join, in which the pages' own columns are one struct
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return pages.withColumns(
        {
            "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def _fits(host: str, path: str) -> Column:
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(path)


def rule_columns(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The text of the longest rule that fits and its verdict (null: none)."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, outcome in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # longer ones are asked first
        text = F.when(_fits(host, path), F.lit(host + path)).otherwise(text)
        verdict = F.when(_fits(host, path), F.lit(outcome)).otherwise(verdict)
    return text, verdict


def _with_levels(hosts: DataFrame, two_label: Sequence[str]) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":\d*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    double = last(2).isin(list(two_label)) & (n >= 2)
    return hosts.withColumns(
        {"suffix": F.when(double, last(2)).otherwise(last(1)), "domain": F.when(double, last(3)).otherwise(last(2))}
    )


def _shrunk(children: DataFrame, name: str) -> DataFrame:
    """``children`` (n, bad, prior: the parent's posterior rate) with the
    posterior's parameters; the prior's strength is estimated over all of them."""
    p, n, bad = F.col("prior"), F.col("n"), F.col("bad")
    scatter = F.sum((bad - n * p) * (bad - n * p) - n * p * (1 - p))
    chance = F.sum(n * (n - 1) * p * (1 - p))
    # correlation of two outcomes of one child; none to see: nearly equal children
    rho = F.when(chance > 0, F.least(F.lit(0.999), F.greatest(F.lit(0.001), scatter / chance))).otherwise(F.lit(0.001))
    strength = children.agg(1 / F.coalesce(rho, F.lit(0.001)) - 1).scalar()
    return children.withColumn("strength", strength).withColumns(
        {f"{name}_a": F.col("strength") * p + bad, f"{name}_b": F.col("strength") * (1 - p) + n - bad}
    ).drop("strength")


def host_reputation(
    pages: DataFrame, outcomes: DataFrame, id_col: str, two_label: Sequence[str] = TWO_LABEL_SUFFIXES, z: float = Z
) -> DataFrame:
    """``pages`` (id, host), ``outcomes`` (id, bad 0/1) -> one row per host:
    ``n_pages``, ``n_labelled``, ``bad_rate`` (posterior mean), ``bad_bound``."""
    seen = outcomes.filter(F.col("bad").isNotNull()).select(F.col(id_col).alias("labelled"), "bad")
    judged = pages.join(seen, F.col(id_col) == F.col("labelled")).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")
    )
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    counts = hosts.join(judged, "host", "left").fillna(0, ["n", "bad"])
    counts = materialise(_with_levels(counts, two_label), "hosts")
    mean = lambda a, b: F.col(a) / (F.col(a) + F.col(b))
    total = counts.agg((F.sum("bad") + 1) / (F.sum("n") + 2)).scalar()
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = materialise(counts.groupBy("suffix", "domain").agg(*sums, F.count(F.lit(1)).alias("hosts")), "domains")
    n_hosts, n_domains = counts.count(), domains.count()
    per_suffix = domains.groupBy("suffix").agg(*sums, F.count(F.lit(1)).alias("domains"))
    suffixes = _shrunk(per_suffix.withColumn("prior", total), "s").select("suffix", mean("s_a", "s_b").alias("prior"), "domains")
    domains = lookup(domains, materialise(suffixes, "suffix-rates"), "suffix", "domains", n_domains)
    domains = _shrunk(materialise(domains, "domain-priors"), "d").select("domain", mean("d_a", "d_b").alias("prior"), "hosts")
    own = lookup(counts, materialise(domains, "domain-rates"), "domain", "hosts", n_hosts)
    own = _shrunk(materialise(own, "host-priors"), "h")
    a, b = F.col("h_a"), F.col("h_b")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return own.select(
        "host", "n_pages", F.col("n").alias("n_labelled"), (a / (a + b)).alias("bad_rate"), (a / (a + b) - z * deviation).alias("bad_bound")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    cutoff: float = CUTOFF,
    two_label: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule``, ``verdict``, ``n_labelled``,
    ``bad_rate`` and ``bad_bound``."""
    parsed = with_host(pages.drop(*RESULT), url_col)
    narrow = materialise(parsed.select(id_col, "host"), "urls")
    reputation = materialise(host_reputation(narrow, outcomes, id_col, two_label).withColumnRenamed("host", "judged_host"), "reputation")
    rule, verdict = rule_columns(rules)
    labelled = reputation.agg(F.sum("n_labelled")).first()[0] or 0
    credibly_bad = (F.col("judged.bad_bound") > cutoff) & F.lit(labelled > 0)
    # one column beside the given ones, so that none of theirs can clash
    hosts = reputation.select(
        F.struct(F.col("judged_host").alias("host")).alias(KEY), F.struct("n_labelled", "bad_rate", "bad_bound").alias("judged"), F.col("n_pages").alias(WEIGHT)
    )
    rows = parsed.select(F.struct("host").alias(KEY), F.struct("*").alias("page"), F.struct(rule.alias("rule"), verdict.alias("verdict")).alias("ruled"))
    found = lookup(rows, hosts, KEY, WEIGHT, narrow.count())
    return found.select("page.*", "ruled.rule", F.coalesce("ruled.verdict", F.when(credibly_bad, "block").otherwise("allow")).alias("verdict"), "judged.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Outcomes: labels of the document with the page's number; bad is toxic or of quality 0."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality IS NOT NULL OR toxic IS NOT NULL")
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))
    rates = [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("bad_rate", "bad_bound")]  # beyond that the order of addition shows
    return judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict", "n_labelled", *rates)


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), outcomes AS (
  SELECT doc_id AS page_id, CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL
), judged AS (
  SELECT host, count(*) AS n, sum(bad) AS bad FROM parsed JOIN outcomes USING (page_id) GROUP BY host
), split AS (
  SELECT host, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', ''), '.') AS labels
  FROM (SELECT DISTINCT host FROM parsed)
), ends AS (
  SELECT host, len(labels) AS k, labels[len(labels)] AS last1,
    array_to_string(labels[greatest(len(labels) - 1, 1) : len(labels)], '.') AS last2,
    array_to_string(labels[greatest(len(labels) - 2, 1) : len(labels)], '.') AS last3
  FROM split
), levels AS (
  SELECT host, CASE WHEN two THEN last2 ELSE last1 END AS suffix, CASE WHEN two THEN last3 ELSE last2 END AS domain
  FROM (SELECT *, k >= 2 AND last2 IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'ne.jp', 'com.br', 'co.in', 'co.kr', 'co.nz', 'com.cn', 'com.mx', 'co.za') AS two FROM ends)
), counts AS (
  SELECT host, suffix, domain, coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad FROM levels LEFT JOIN judged USING (host)
), suffix0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM counts) AS p FROM counts GROUP BY suffix
), suffix1 AS (
  SELECT *, (SELECT 1 / CASE WHEN sum(n * (n - 1) * p * (1 - p)) > 0
      THEN least(0.999, greatest(0.001, sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)))) ELSE 0.001 END - 1 FROM suffix0) AS s
  FROM suffix0
), domain0 AS (
  SELECT suffix, domain, sum(c.n) AS n, sum(c.bad) AS bad, any_value((x.s * x.p + x.bad) / (x.s * x.p + x.bad + x.s * (1 - x.p) + x.n - x.bad)) AS p
  FROM counts c JOIN suffix1 x USING (suffix) GROUP BY suffix, domain
), domain1 AS (
  SELECT *, (SELECT 1 / CASE WHEN sum(n * (n - 1) * p * (1 - p)) > 0
      THEN least(0.999, greatest(0.001, sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)))) ELSE 0.001 END - 1 FROM domain0) AS s
  FROM domain0
), host0 AS (
  SELECT c.host, c.n, c.bad, (x.s * x.p + x.bad) / (x.s * x.p + x.bad + x.s * (1 - x.p) + x.n - x.bad) AS p
  FROM counts c JOIN domain1 x USING (domain)
), host1 AS (
  SELECT *, (SELECT 1 / CASE WHEN sum(n * (n - 1) * p * (1 - p)) > 0
      THEN least(0.999, greatest(0.001, sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)))) ELSE 0.001 END - 1 FROM host0) AS s
  FROM host0
), posterior AS (
  SELECT host, n, s * p + bad AS a, s * (1 - p) + n - bad AS b FROM host1
), reputation AS (
  SELECT host, n::BIGINT AS n_labelled, a / (a + b) AS rate, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
), ruled AS (
  SELECT page_id, host, path, CASE
      WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM parsed
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN bound > 0.5 AND (SELECT sum(n_labelled) FROM reputation) > 0 THEN 'block'
    ELSE 'allow' END AS verdict,
  n_labelled, round(rate, 6) + 0.0 AS bad_rate, round(bound, 6) + 0.0 AS bad_bound
FROM ruled JOIN reputation USING (host)
"""
