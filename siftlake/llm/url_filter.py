"""URL filter with link-graph propagation (operator 5); DataFrame functions only.

Rules of host and path prefix judge the pages they fit, the longest rule first. The other pages get their
host's verdict: trust spreads from the hosts of allowed pages along links, distrust from those of blocked pages
against links, each a personalised PageRank over the graph of distinct host-to-host links; a host whose distrust
exceeds its trust by more than ``margin`` is blocked, any other allowed; equal trust and distrust allow. Ranks go
through ``ROUNDS`` rounds, or fewer if a round changes none, which no later round would then do either.

Ranks are whole numbers out of ``SCALE`` and every share is rounded down, so sums do not depend on their order
and a result is the same on every run. Seeds are pages per host, over all pages. A page's links are its
``href`` targets with a host; a link into its own host says nothing about others and is left out.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed unless the empty
host were blocked, which has no links and no seeds; null html has no links; repeated rows count each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.operators.attach import attach
from siftlake.session import checkpointed

SCALE = 10**15
#: After so many rounds less than a ten-thousandth of the mass (0.85 ** 57) is still on its way.
ROUNDS, DAMPING = 57, 85
#: Rounds after which the ranks are written out, to cut the plan, and compared with the next ones.
EVERY = 5
#: Links of one host that a task takes, about.
LINKS = 100_000
#: Blocked hosts that are sent to every executor, some 16 MB; beyond it pages are joined with large hosts spread.
FEW = 200_000
#: Nothing in it is tried twice, so that its time grows with the text.
HREF = r"""(?i)\bhref\s*+=\s*+["']?+\s*+((?:[a-z][a-z0-9+.-]*+:)?+//[^/?#"'\s<>]++)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: src, dst. Needs the columns host and html."""
    targets = F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1))))
    dst = F.translate(F.regexp_extract("target", r"//(.*)$", 1), UPPER, LOWER)
    links = pages.select(F.col("host").alias("src"), targets.alias("target")).select("src", dst.alias("dst"))
    return links.filter("src <> '' AND dst <> '' AND src <> dst").distinct()


def _fingerprint(ranks: DataFrame) -> tuple:
    return tuple(ranks.agg(F.count("*"), F.sum(F.xxhash64("kind", "host", "rank").cast("decimal(20,0)"))).first())


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING, limit: int = LINKS) -> DataFrame:
    """Ranks by (kind, host). ``seeds``: kind, host, seed; ``links``: kind, src, dst, with the direction of its kind.

    The links of a host with more than ``limit`` are split by their targets, and its rank is sent to each part.
    """
    parts = F.ceil(F.col("degree") / limit)
    degrees = checkpointed(links.groupBy("kind", F.col("src").alias("host")).agg(F.count("*").alias("degree")))
    marked = links.join(degrees.withColumnRenamed("host", "src"), ["kind", "src"])
    links = checkpointed(marked.select("kind", "src", "dst", F.pmod(F.xxhash64("dst"), parts).alias("part")))
    seeds = checkpointed(seeds)
    base = seeds.select("kind", "host", F.expr(f"seed * {100 - damping}").alias("share"))

    def following(ranks: DataFrame) -> DataFrame:
        given = ranks.join(degrees, ["kind", "host"]).filter("rank >= degree")
        given = given.select("kind", F.col("host").alias("src"), F.expr(f"(rank div degree) * {damping}").alias("share"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
        given = links.join(given, ["kind", "src", "part"]).select("kind", F.col("dst").alias("host"), "share")
        return base.unionByName(given).groupBy("kind", "host").agg(F.expr("sum(share) div 100").alias("rank"))

    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    for i in range(rounds):
        ranks = following(ranks)
        if (i + 1) % EVERY == 0 or i == 0:
            ranks = checkpointed(ranks)
            if _fingerprint(ranks) == _fingerprint(following(ranks)):
                break
    return ranks


def judge_urls(pages: DataFrame, rules: list[Rule], margin: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = split.select("page_id", "host", "path", rule.alias("rule"), by_rule.alias("by_rule"))

    counts = judged.filter("by_rule IS NOT NULL").groupBy(F.col("by_rule").alias("kind"), "host").agg(F.count("*").cast("decimal(18,0)").alias("pages"))
    totals = counts.groupBy("kind").agg(F.sum("pages").cast("decimal(18,0)").alias("total"))
    seeds = counts.join(totals, "kind").select("kind", "host", F.expr(f"(CAST({SCALE} AS DECIMAL(16,0)) * pages) div total").cast("long").alias("seed"))
    links = host_links(split)
    both = links.select(F.lit("allow").alias("kind"), "src", "dst").unionByName(links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    ranks = propagate(seeds, both, rounds)
    signed = F.when(F.col("kind") == "block", F.col("rank")).otherwise(-F.col("rank"))
    blocked = checkpointed(ranks.groupBy("host").agg(F.sum(signed).alias("excess")).filter(F.col("excess") > margin).select("host", F.lit("block").alias("by_host")))
    out = ("page_id", "host", "path", "rule")
    ruled = judged.filter("by_rule IS NOT NULL").select(*out, F.col("by_rule").alias("verdict"))
    others = judged.filter("by_rule IS NULL")
    if blocked.count() <= FEW:
        others = others.join(F.broadcast(blocked), "host", "left")
    else:
        facts = others.groupBy("host").agg(F.count("*").alias("pages")).join(blocked, "host", "left")
        others = attach(others.withColumn("seq", F.xxhash64("page_id", "path")), checkpointed(facts), "host", "pages")
    return ruled.unionByName(others.select(*out, F.coalesce("by_host", F.lit("allow")).alias("verdict")))


def judge_urls_sql(rules: list[Rule], rounds: int = ROUNDS, damping: int = DAMPING, margin: int = 0) -> str:
    """The same result over ``pages`` in SQL."""
    cases = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN" for r in cases]
    name = " ".join(f"{fit} '{r.name}'" for fit, r in zip(fits, cases, strict=True))
    verdict = " ".join(f"{fit} '{r.verdict}'" for fit, r in zip(fits, cases, strict=True))
    # The same pattern; this engine never goes back.
    href = HREF.replace("*+", "*").replace("?+", "?").replace("++", "+").replace("'", "''")
    return f"""WITH RECURSIVE cut AS (
        SELECT page_id, coalesce(html, '') AS html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
      parts AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
      judged AS MATERIALIZED (SELECT page_id, host, path, CASE {name} END AS rule, CASE {verdict} END AS by_rule FROM parts),
      counts AS (SELECT by_rule AS kind, host, count(*) AS pages FROM judged WHERE by_rule IS NOT NULL GROUP BY ALL),
      seeds AS MATERIALIZED (SELECT kind, host, ({SCALE}::HUGEINT * pages // sum(pages) OVER (PARTITION BY kind))::BIGINT AS seed FROM counts),
      targets AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS target FROM parts),
      links AS (SELECT DISTINCT src, translate(regexp_extract(target, '//(.*)$', 1), '{UPPER}', '{LOWER}') AS dst FROM targets),
      kept AS MATERIALIZED (SELECT src, dst FROM links WHERE src <> '' AND dst <> '' AND src <> dst),
      directed AS (SELECT 'allow' AS kind, src, dst FROM kept UNION ALL SELECT 'block', dst, src FROM kept),
      edges AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, src) AS degree FROM directed),
      ranks AS (SELECT 0 AS i, kind, host, seed AS rank FROM seeds UNION ALL
        SELECT i, kind, host, (sum(part) // 100)::BIGINT AS rank FROM (
          SELECT n.i + 1 AS i, s.kind, s.host, s.seed * {100 - damping} AS part FROM seeds s, (SELECT max(i) AS i FROM ranks) n WHERE n.i < {rounds}
          UNION ALL SELECT r.i + 1, l.kind, l.dst, (r.rank // l.degree) * {damping} FROM edges l JOIN ranks r ON r.kind = l.kind AND r.host = l.src WHERE r.i < {rounds})
        GROUP BY i, kind, host),
      blocked AS (SELECT host FROM ranks WHERE i = {rounds} GROUP BY host HAVING sum(CASE WHEN kind = 'block' THEN rank ELSE -rank END) > {margin})
      SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM judged"""
