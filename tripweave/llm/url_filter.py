"""URL filter: rules by host and path, and trust propagated over host links for all other urls.

Host links are the absolute links of all pages, one edge per pair of hosts.
Trust runs along the links from trusted hosts, distrust against the links from
blocked hosts: two personalised PageRanks in one set of joins.  A host is a
seed if the rules judge more than half of its pages one way.  Ranks are whole
numbers (``UNIT`` per seed), so that results do not depend on the order in
which tasks add them up.  Rounds go on until no rank grows by more than
``SETTLED``: ranks only grow, each round by at most ``DAMPING`` per cent of what
the round before added, so the ranks of far hosts are as complete as those of near
ones.  A page that no rule fits is blocked if its host's distrust reaches
``BLOCK_AT`` and exceeds its trust.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed; null html has no links; repeated rows are judged each and count
once each towards seeds, but once per pair of hosts as links; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import saved

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UNIT = 1_000_000_000
DAMPING = 85  # per cent of a rank that is passed on
SETTLED = UNIT // 1_000_000  # growth of a rank in a round that is too small to go on
BLOCK_AT = UNIT // 50
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def with_host_and_path(pages: DataFrame) -> DataFrame:
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumns(
        {"host": F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), "path": F.coalesce(path, F.lit(""))}
    )


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct (rule, verdict) of the longest rule that fits, else null; of equally long ones the first by text."""
    chosen = None
    for at, start, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(start))
        found = F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found) if chosen is None else chosen.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if chosen is None else chosen


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct (a, b): a page of host a links to host b; over pages (host, html)."""
    return (
        pages.where("host <> ''")
        .select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("to"))
        .select(F.col("host").alias("a"), F.translate("to", UPPER, LOWER).alias("b"))
        .where("a <> b")
        .distinct()
    )


def propagate(links: DataFrame, seeds: DataFrame, settled: int = SETTLED, damping: int = DAMPING) -> DataFrame:
    """kind, host, rank: personalised PageRank of seeds (kind, host) over the links (a, b).

    Kind ``trust`` follows links, kind ``distrust`` runs against them.  A round
    is written to the shared folder before its growth is looked at.
    """
    both = links.select(F.lit("trust").alias("kind"), "a", "b").union(
        links.select(F.lit("distrust").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"))
    )
    degrees = both.groupBy("kind", "a").agg(F.count("*").alias("degree"))
    edges = saved(both.join(degrees, ["kind", "a"]), "url-edges")
    zero = F.lit(0).cast("long")
    again = seeds.select("kind", "host", F.expr(f"{UNIT}L * {100 - damping} div 100").alias("rank"), zero.alias("before"))
    ranks = again.select("kind", "host", "rank")
    if edges.isEmpty():
        return ranks
    while True:
        passed = (
            ranks.select("kind", F.col("host").alias("a"), "rank")
            .join(edges, ["kind", "a"])
            .select("kind", F.col("b").alias("host"), F.expr(f"rank * {damping} div 100 div degree").alias("rank"), zero.alias("before"))
        )
        old = ranks.select("kind", "host", zero.alias("rank"), F.col("rank").alias("before"))
        grown = again.union(passed).union(old).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before"))
        grown = saved(grown.where("rank > 0"), "url-ranks")
        ranks = grown.select("kind", "host", "rank")
        if grown.where(F.col("rank") - F.col("before") > settled).isEmpty():
            return ranks


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, settled: int = SETTLED, block_at: int = BLOCK_AT
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of pages (page_id, url, html)."""
    parsed = with_host_and_path(pages.select("page_id", "url", "html"))
    ruled = parsed.withColumn("found", best_rule(F.col("host"), F.col("path"), rules))
    share = ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("found.verdict") == "block").alias("blocked"),
    )
    seeds = saved(
        share.select(
            F.when(F.col("allowed") * 2 > F.col("n"), "trust")
            .when(F.col("blocked") * 2 > F.col("n"), "distrust")
            .alias("kind"),
            "host",
        ).where("kind IS NOT NULL"),
        "url-seeds",
    )
    ranks = propagate(host_links(parsed), seeds, settled)
    scores = ranks.groupBy(F.col("host").alias("_host")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0)).alias("distrust"),
    )
    zero = F.lit(0).cast("long")
    judged = ruled.select("page_id", "host", "path", "found").join(scores, F.col("host") == F.col("_host"), "left")
    trust, distrust = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    own = F.when((distrust >= block_at) & (distrust > trust), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
    )


def _sql() -> str:
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    )
    verdicts = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE raw AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM raw),
ruled AS (SELECT *, CASE {cases} END AS rule FROM parsed),
judged AS (SELECT *, CASE rule {verdicts} END AS given FROM ruled),
seeds AS (
  SELECT CASE WHEN 2 * count(*) FILTER (WHERE given = 'allow') > count(*) THEN 'trust'
    WHEN 2 * count(*) FILTER (WHERE given = 'block') > count(*) THEN 'distrust' END AS kind, host
  FROM judged WHERE host <> '' GROUP BY host),
links AS (
  SELECT DISTINCT host AS a, translate(l, '{UPPER}', '{LOWER}') AS b
  FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS l FROM parsed WHERE host <> '') WHERE a <> b),
directed AS (SELECT 'trust' AS kind, a, b FROM links UNION ALL SELECT 'distrust', b, a FROM links),
edges AS (SELECT *, count(*) OVER (PARTITION BY kind, a) AS degree FROM directed),
again AS (SELECT kind, host, ({UNIT}::BIGINT * {100 - DAMPING}) // 100 AS rank FROM seeds WHERE kind IS NOT NULL),
rounds AS (
  SELECT 0 AS round, kind, host, rank, rank AS grown FROM again
  UNION ALL
  SELECT * FROM (
    SELECT any_value(round) + 1, kind, host, sum(rank)::BIGINT AS rank, (sum(rank) - sum(before))::BIGINT AS grown FROM (
      SELECT round, kind, host, 0 AS rank, rank AS before FROM rounds
      UNION ALL SELECT (SELECT max(round) FROM rounds), kind, host, rank, 0 FROM again
      UNION ALL SELECT r.round, e.kind, e.b, (r.rank * {DAMPING} // 100) // e.degree, 0
        FROM rounds r JOIN edges e ON e.kind = r.kind AND e.a = r.host) s
    GROUP BY kind, host HAVING sum(rank) > 0) g
  WHERE (SELECT max(grown) FROM rounds) > {SETTLED} AND EXISTS (SELECT 1 FROM edges)),
scores AS (
  SELECT host, sum(CASE WHEN kind = 'trust' THEN rank ELSE 0 END)::BIGINT AS trust,
    sum(CASE WHEN kind = 'distrust' THEN rank ELSE 0 END)::BIGINT AS distrust FROM rounds WHERE round = (SELECT max(round) FROM rounds) GROUP BY host)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.given, CASE WHEN s.distrust >= {BLOCK_AT} AND s.distrust > s.trust THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(s.trust, 0)::BIGINT AS trust, coalesce(s.distrust, 0)::BIGINT AS distrust
FROM judged j LEFT JOIN scores s ON s.host = j.host"""


SQL = _sql()
