"""URL filters: fixed rules first, then the reputation of the host.

A host's share of good pages is shrunk by empirical Bayes. Labelled outcomes are counted
per host; each level takes its Beta prior from the level above it, from host to registered
domain to suffix to all pages. A prior's mean is the posterior mean of the level above, its
strength comes from how much more the counts of a level scatter than binomial counts would
(method of moments). A host is blocked when its share of good pages surely lies below a floor: the
posterior mean plus ``DEVIATIONS`` standard deviations of the Beta posterior is less than that.

Defined cases: a NULL URL or one without ``://`` has an empty host and path, and no label; it
gets the prior of all pages. Repeated pages are judged (and counted) once a row. Several labels of
one document count as one, good only if all are. An empty table gives an empty result, no labels
allow every page no rule blocks. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.session import release, stable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Suffixes of two labels below which names are registered; a parameter, any other suffix is one label.
SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "org.uk")

#: Least share of good pages, and how sure its bound is (one-sided, 0.95 for a normal posterior).
FLOOR, DEVIATIONS = 0.5, 1.645

#: Prior strengths allowed, in pages; the first is taken where nothing can be learnt.
STRENGTH, WEAKEST, STRONGEST = 10.0, 2.0, 1000.0

#: Hosts that are broadcast at most; beyond that the join with pages is shuffled.
BROADCAST_ROWS = 200_000

#: Rules that become one expression at most; more are joined by host and path start.
INLINE_RULES = 64


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def host_name(host: Column) -> Column:
    """A host without user and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def suffix_of(name: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The last label of a name, or the last two if they are a known suffix."""
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(name: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The registered domain: the suffix and one label before it."""
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)


def _order(rules: Sequence[Rule]) -> list[Rule]:
    """The longest first; of equal names ``block`` wins."""
    return sorted(set(rules), key=lambda r: (-len(r.name), r.name, r.verdict != "block"))


def with_rule(urls: DataFrame, rules: Sequence[Rule] = RULES, inline: int = INLINE_RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` (NULL where none fits) to rows with ``host`` and ``path``."""
    ranked = _order(rules)
    if len(ranked) <= inline:
        fits = [
            (((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path), r) for r in ranked
        ]

        def first(value: str) -> Column:
            if not fits:
                return F.lit(None).cast("string")
            return functools.reduce(lambda chain, f: chain.when(f[0], getattr(f[1], value)), fits[1:], F.when(fits[0][0], getattr(fits[0][1], value)))

        return urls.withColumn("rule", first("name")).withColumn("rule_verdict", first("verdict"))
    # Distinct (host, path) pairs meet rules on equal ends of the host and equal starts of the path.
    spark = urls.sparkSession
    best = {}
    for rank, r in enumerate(ranked):
        best.setdefault((r.host, r.path), (rank, r.name, r.verdict))
    table = spark.createDataFrame([(*k, *v) for k, v in best.items()], "__end string, __start string, __rank int, rule string, rule_verdict string")
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in ranked})])
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = urls.select("host", "path").distinct()
    starts = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    opened = pairs.withColumn("__end", F.explode(ends)).withColumn("__start", F.explode(starts))
    found = opened.join(table, ["__end", "__start"]).groupBy("host", "path").agg(F.min_by(F.struct("rule", "rule_verdict"), "__rank").alias("__r"))
    return urls.join(found.select("host", "path", "__r.rule", "__r.rule_verdict"), ["host", "path"], "left").select(*urls.columns, "rule", "rule_verdict")


def strength(level: DataFrame) -> float:
    """Strength of the Beta prior of a level from its rows ``n``, ``good`` and prior ``mean``, by moments.

    The variance of a beta-binomial count is ``n m (1-m) (1 + (n-1) r)`` and the strength is ``1/r - 1``.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    row = level.agg(
        F.sum((F.col("good") - F.col("n") * F.col("mean")) ** 2 - F.col("n") * spread).alias("more"),
        F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("most"),
    ).first()
    if not row["most"]:
        return STRENGTH
    share = row["more"] / row["most"]
    return STRONGEST if share <= 0 else min(max(1 / share - 1, WEAKEST), STRONGEST)


def _posterior(level: DataFrame, weight: float, *names: str) -> DataFrame:
    """Parameters of the Beta posterior of each row, and its mean."""
    a = F.col("good") + weight * F.col("mean")
    b = F.col("n") - F.col("good") + weight * (1 - F.col("mean"))
    return level.select(*names, "n", "good", a.alias("a"), b.alias("b"))


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES, deviations: float = DEVIATIONS) -> DataFrame:
    """Posterior of each host of ``outcomes`` (``host``, ``n`` labelled pages, ``good`` ones).

    Adds ``domain``, ``suffix``, the posterior ``mean`` of the share of good pages and its ``lower`` and
    ``upper`` bound. One row a host, which may have no labelled page.
    """
    name = host_name(F.col("host"))
    hosts = outcomes.select("host", "n", "good", domain_of(name, suffixes).alias("domain"), suffix_of(name, suffixes).alias("suffix"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = ends.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = F.lit(((total["good"] or 0) + 1.0) / ((total["n"] or 0) + 2.0))

    ends = ends.withColumn("mean", mean)
    ends = _posterior(ends, strength(ends), "suffix").select("suffix", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"))
    domains = domains.join(ends, "suffix")
    domains = _posterior(domains, strength(domains), "suffix", "domain").select("suffix", "domain", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"))
    hosts = hosts.join(domains, ["suffix", "domain"])
    found = _posterior(hosts, strength(hosts), "host", "domain", "suffix")
    size = F.col("a") + F.col("b")
    off = deviations * F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    return found.select(
        "host", "domain", "suffix", "n", "good", (F.col("a") / size).alias("mean"), (F.col("a") / size - off).alias("lower"), (F.col("a") / size + off).alias("upper")
    )


def host_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled and good pages of every host of ``pages`` (``host``, ``path``).

    The second part of a path that begins with digits names the document a page shows
    (``/en/7817.html``); a page is good if its document has quality 1 and is not toxic.
    """
    doc = F.expr(r"try_cast(regexp_extract(path, '^/[^/]*/([0-9]+)', 1) AS bigint)")
    # Counted before the join, so a page repeated any number of times is one row.
    shown = pages.groupBy("host", doc.alias("doc")).agg(F.count(F.lit(1)).alias("rows"))
    judged = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("doc"))
        .agg(F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("long")).alias("fine"))
    )
    found = shown.filter(F.col("doc").isNotNull()).join(judged, "doc").select("host", F.col("rows").alias("n"), (F.col("rows") * F.col("fine")).alias("good"))
    none = shown.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("good"))
    return found.union(none).groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def judge_pages(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, floor: float = FLOOR, id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, the ``rule`` that fits and the ``verdict``."""
    urls = pages.select(F.col(id), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    outcomes = stable(host_outcomes(urls.select("host", "path"), labels))
    known = stable(reputations(outcomes).select("host", (F.col("upper") < floor).alias("bad")))
    release(outcomes)
    few = known.count() <= BROADCAST_ROWS
    judged = with_rule(urls, rules).join(F.broadcast(known) if few else known, "host", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.select(id, "host", "path", "rule", verdict.alias("verdict"))


#: The same in SQL, for the query.
ORACLE = rf"""
WITH urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages
),
rules(host, path, verdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}),
fits AS (
  SELECT DISTINCT u.host, u.path, r.host || r.path AS rule, r.verdict FROM (SELECT DISTINCT host, path FROM urls) u
  JOIN rules r ON (u.host = r.host OR u.host LIKE '%.' || r.host) AND starts_with(u.path, r.path)
),
ruled AS (SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule, verdict DESC) = 1),
judged AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS fine
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
),
outcomes AS (
  SELECT host, count(fine) AS n, coalesce(sum(fine), 0) AS good
  FROM urls LEFT JOIN judged ON doc_id = try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') AS BIGINT) GROUP BY 1
),
named AS (SELECT *, string_split(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '.') AS l FROM outcomes),
parts AS (
  SELECT host, n, good, CASE WHEN array_to_string(l[-2:], '.') IN ({", ".join(f"'{s}'" for s in SUFFIXES)}) THEN 2 ELSE 1 END AS k, l FROM named
),
hosts AS (SELECT host, n, good, array_to_string(l[-k:], '.') AS suffix, array_to_string(l[-k - 1:], '.') AS domain FROM parts),
s0 AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(m) AS m
  FROM hosts, (SELECT (sum(good) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) AS m FROM hosts) GROUP BY 1
),
s1 AS (SELECT *, {{s0}} AS w FROM s0),
s2 AS (SELECT suffix, (good + w * m) / (n + w) AS m FROM s1),
d0 AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good, any_value(m) AS m FROM hosts JOIN s2 USING (suffix) GROUP BY 1, 2),
d1 AS (SELECT *, {{s0}} AS w FROM d0),
d2 AS (SELECT suffix, domain, (good + w * m) / (n + w) AS m FROM d1),
h0 AS (SELECT host, n, good, m FROM hosts JOIN d2 USING (suffix, domain)),
h1 AS (SELECT *, {{s0}} AS w FROM h0),
h2 AS (SELECT host, good + w * m AS a, n - good + w * (1 - m) AS b FROM h1),
bad AS (SELECT host FROM h2 WHERE a / (a + b) + {DEVIATIONS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < {FLOOR})
SELECT page_id, u.host, u.path, r.rule, coalesce(r.verdict, CASE WHEN u.host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN ruled r ON r.host = u.host AND r.path = u.path
""".replace(
    "{s0}",
    f"""(SELECT CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)) OVER (), 0) = 0 THEN {STRENGTH}
      WHEN sum((good - n * m) ** 2 - n * m * (1 - m)) OVER () <= 0 THEN {STRONGEST}
      ELSE least(greatest(sum(n * (n - 1) * m * (1 - m)) OVER () / sum((good - n * m) ** 2 - n * m * (1 - m)) OVER () - 1, {WEAKEST}), {STRONGEST}) END)""",
)
