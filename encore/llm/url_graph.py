"""URL filter: fixed rules by host and path, and trust spread over host links.

Hosts that the rules mostly allow are trusted seeds, hosts that they mostly block
are distrusted seeds. Personalised PageRank spreads trust along links and distrust
against them (who links to a blocked host is suspect); each seed injects its own
mass, so a score does not depend on how many seeds there are. Distrust is the
larger of two scores: the mass that blocked hosts share among all who link to them,
and the personalised PageRank that blocked hosts have from the host itself, which
depends on the host's own links and not on how many others link to the same seeds.
A page without a rule is blocked when its host's distrust exceeds its trust by
``threshold``. A linked host without pages is a seed by the rules of the linked urls.
Rounds end when no host's score moves by more than ``tolerance``.

Host links come from absolute links in the pages' html. Pages are reduced to one
row per host and per linked pair of hosts before anything iterates; each round
aggregates what a host receives before the shuffle, and the hosts' scores meet
the links in ``lookup_join``, which spreads a host with very many links or linkers. Every
round's scores are written to the shared folder.

Defined results: a NULL url, or one without ``://``, has an empty host and path,
matches no rule and is allowed; NULL html has no links; repeated rows each get a
row; links of a host to itself are not counted; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import drop_stored, lookup_join, stored

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)"""
TARGET = LINK[:-1] + r"""[^?#"'<>\x20\x09-\x0D]*)"""  # with the path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, empty where it is NULL or has no ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): pages of host ``src`` with a link to another host ``dst``."""
    host, _ = url_parts(F.col(url))
    return (pages.select(host.alias("src"), F.explode(F.array_distinct(F.transform(
                F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)),
                lambda x: F.translate(x, UPPER, LOWER)))).alias("dst"))
            .where((F.col("src") != "") & (F.col("dst") != F.col("src")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def linked_hosts(pages: DataFrame, hosts: DataFrame, html: str = "html", rules=RULES) -> DataFrame:
    """(host, n_pages, n_allow, n_block) of the linked hosts that are not in ``hosts``,
    counted over the links to them; a link without a path is to ``/``."""
    at = F.col("_target")
    path = F.regexp_extract(at, "^[^/]+(.*)$", 1)
    targets = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(TARGET), F.lit(1))).alias("_target"))
    parts = targets.select(F.translate(F.regexp_extract(at, "^[^/]+", 0), UPPER, LOWER).alias("host"),
                           F.when(path == "", "/").otherwise(path).alias("path"))
    _, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return (parts.select("host", verdict.alias("_v")).groupBy("host").agg(
                F.count(F.lit(1)).alias("n_pages"), F.count(F.when(F.col("_v") == "allow", 1)).alias("n_allow"),
                F.count(F.when(F.col("_v") == "block", 1)).alias("n_block"))
            .join(hosts.select("host"), "host", "left_anti"))


def spread(links: DataFrame, seeds: DataFrame, rounds: int, damping: float, tolerance: float) -> DataFrame:
    """(kind, host, score): a personalised PageRank for each kind of score, from its
    ``seeds`` (kind, host) over its ``links`` (kind, src, dst, share), share being the part
    of src's score that dst gets. All kinds spread in the same rounds: at most ``rounds``,
    fewer if a round moves no score by more than ``tolerance``."""
    start = seeds.select("kind", "host", F.lit(1 - damping).alias("score"))
    fans = links.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("_fan"))
    scores, held = start, None
    zero = F.lit(0.0)
    for k in range(rounds):
        giving = fans.join(scores.withColumnRenamed("host", "src"), ["kind", "src"])
        given = lookup_join(links, giving, ["kind", "src"], "_fan").where(F.col("score").isNotNull()).select(
            "kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score"))
        parts = (start.unionByName(given).withColumn("before", zero)
                 .unionByName(scores.select("kind", "host", zero.alias("score"), F.col("score").alias("before"))))
        seen = Observation()
        new = (parts.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before"))
               .observe(seen, F.max(F.abs(F.col("score") - F.col("before"))).alias("moved"))
               .select("kind", "host", "score"))
        new = stored(new, f"url-scores-{k}")
        if held is not None:
            drop_stored(held)
        scores = held = new
        if (seen.get["moved"] or 0.0) <= tolerance:
            break
    return scores


def host_scores(hosts: DataFrame, links: DataFrame, rounds: int = 100, damping: float = 0.85,
                tolerance: float = 1e-3) -> DataFrame:
    """(host, trust, distrust) of every host with a score.

    ``hosts`` is (host, n_pages, n_allow, n_block), ``links`` as ``host_links``."""
    def ends(end: str, total: str) -> DataFrame:
        return links.groupBy(end).agg(F.sum("n").alias(total), F.count(F.lit(1)).alias("_fan"))

    def edges(kind: str, src: str, dst: str, share: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(src).alias("src"), F.col(dst).alias("dst"), share.alias("share"))

    shares = lookup_join(lookup_join(links, ends("src", "_out"), ["src"], "_fan"), ends("dst", "_in"), ["dst"], "_fan")
    out, into = F.col("n") / F.col("_out"), F.col("n") / F.col("_in")
    # The last: of a host's own links the part to each target, which no growth of the target's in-degree dilutes.
    spreading = stored(shares.select(F.inline(F.array(
        edges("trust", "src", "dst", out), edges("shared", "dst", "src", into), edges("own", "dst", "src", out)))),
        "url-shares")
    trusted = hosts.where(F.lit(2) * F.col("n_allow") > F.col("n_pages")).select(F.lit("trust").alias("kind"), "host")
    blocked = hosts.where(F.lit(2) * F.col("n_block") > F.col("n_pages")).select("host")
    seeds = trusted
    for kind in ("shared", "own"):
        seeds = seeds.unionByName(blocked.select(F.lit(kind).alias("kind"), "host"))
    n = rounds if links.head(1) else 0  # without links the seeds keep their own score
    scores = spread(spreading, seeds, n, damping, tolerance)
    trust = F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)
    distrust = F.when(F.col("kind") != "trust", F.col("score")).otherwise(0.0)
    return scores.groupBy("host").agg(F.sum(trust).alias("trust"), F.max(distrust).alias("distrust"))


def url_filter(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               rules=RULES, rounds: int = 100, damping: float = 0.85,
               threshold: float = 0.05, tolerance: float = 1e-3) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, distrust."""
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parts.select("*", rule.alias("rule"), verdict.alias("_rule_verdict"))
    hosts = stored(judged.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count(F.when(F.col("_rule_verdict") == "allow", 1)).alias("n_allow"),
        F.count(F.when(F.col("_rule_verdict") == "block", 1)).alias("n_block")), "url-hosts")
    links = stored(host_links(pages, url, html), "url-links")
    seeds = hosts
    if links.head(1):
        seeds = stored(hosts.unionByName(linked_hosts(pages, hosts, html, rules)), "url-seeds")
    scores = host_scores(seeds, links, rounds, damping, tolerance)
    bad = (hosts.join(scores, "host")
           .where(F.col("distrust") - F.col("trust") > threshold)
           .select("host", F.col("n_pages").alias("_n"), "distrust"))
    return lookup_join(judged, bad, ["host"], "_n").select(
        "page_id", "host", "path", "rule",
        F.coalesce("_rule_verdict", F.when(F.col("distrust").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"))


RULE_SQL = r"""CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END"""


def _oracle(rounds: int = 60) -> str:
    """SQL of the query; its rounds are unrolled (after 60, 0.85^60 of the mass still moves)."""
    steps = []
    for name, seed, a, b, of in (("tr", "n_allow", "src", "dst", "src"), ("di", "n_block", "dst", "src", "dst"),
                                 ("bk", "n_block", "dst", "src", "src")):
        steps.append(f"{name}0 AS (SELECT host, 0.15::double AS s FROM seeds WHERE 2 * {seed} > n_pages)")
        steps.append(f"{name}e AS MATERIALIZED (SELECT {a} AS a, {b} AS b, n / sum(n) OVER (PARTITION BY {of}) AS share FROM links)")
        for k in range(1, rounds + 1):
            steps.append(
                f"{name}{k} AS MATERIALIZED (SELECT host, sum(s) AS s FROM (SELECT host, s FROM {name}0 UNION ALL "
                f"SELECT e.b, 0.85::double * p.s * e.share FROM {name}{k - 1} p JOIN {name}e e ON e.a = p.host) "
                "GROUP BY host)")
    return r"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, url, html, CASE WHEN strpos(url, '://') > 0
           THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT r, page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT *, """ + RULE_SQL + r""" AS rule FROM p),
hosts AS (
  SELECT host, count(*) AS n_pages,
         count(*) FILTER (WHERE rule IN ('example.net/en/', 'org/fr/')) AS n_allow,
         count(*) FILTER (WHERE rule IN ('net/', 'example.com/de/')) AS n_block
  FROM j WHERE host <> '' GROUP BY host),
raw AS (
  SELECT r, host AS src, unnest(regexp_extract_all(html,
    '(?i)(?:href|src)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^?#"''<>\x20\x09-\x0D]+)', 1)) AS target
  FROM j),
tg AS (
  SELECT r, src, translate(regexp_extract(target, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN contains(target, '/') THEN substr(target, strpos(target, '/')) ELSE '/' END AS path
  FROM raw WHERE NOT prefix(target, '/')),
linked AS (
  SELECT host, count(*) AS n_pages,
         count(*) FILTER (WHERE rule IN ('example.net/en/', 'org/fr/')) AS n_allow,
         count(*) FILTER (WHERE rule IN ('net/', 'example.com/de/')) AS n_block
  FROM (SELECT *, """ + RULE_SQL + r""" AS rule FROM tg) GROUP BY host),
seeds AS MATERIALIZED (SELECT * FROM hosts UNION ALL SELECT * FROM linked WHERE host NOT IN (SELECT host FROM hosts)),
lk AS (SELECT DISTINCT r, src, host AS dst FROM tg),
links AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM lk WHERE src <> '' AND src <> dst GROUP BY src, dst),
""" + ",\n".join(steps) + f""",
ds AS (SELECT host, max(s) AS s FROM (SELECT * FROM di{rounds} UNION ALL SELECT * FROM bk{rounds}) GROUP BY host),
bad AS (SELECT d.host FROM ds d LEFT JOIN tr{rounds} t USING (host) WHERE d.s - coalesce(t.s, 0) > 0.05)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


ORACLE_SQL = _oracle()
