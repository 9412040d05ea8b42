"""URL filters: host and path rules, and trust and distrust that spread over the links between hosts, in DataFrame operations only.

Edges are links between different hosts, summed before they are shuffled. Trust starts at trusted hosts and follows links forward, distrust starts at blocked hosts and follows them backward (who links to bad hosts is bad), each a personalised PageRank: DAMPING of a host's score goes along its links in proportion, the rest returns to the seeds; what reaches a host without links ends there. Each round is one join and one sum, written to the shared folder; rounds end when all scores together move by less than TOLERANCE (what moves shrinks by DAMPING a round at least, so this comes). A host whose distrust exceeds its trust is blocked where no rule decides.

Seeds: a host is trusted if rules allow more than half of its pages, blocked if rules block more than half of them; a table of seeds names more hosts of either kind, whether they have pages or are only linked to. A host that is named by both is a seed of both kinds, and neither wins at the seed itself.

Defined results: a null url or one without :// has an empty host and path, fits no rule, links nowhere, is no seed and is allowed; a null html has no links; a null or repeated page_id is kept as it is; repeated rows get equal verdicts and count as more links and pages; without seeds or links every score is 0 or the seed's own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

# Fixed values: (verdict, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
DAMPING = 0.85
TOLERANCE = 1e-6
#: Rules beyond which one expression is no longer fit.
MOST_RULES = 1000
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def matching_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null: none), and its verdict."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    rule = verdict = None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)


def split_url(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, URL, 1)), F.regexp_extract(url, URL, 2)


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target, links) between different hosts."""
    links = pages.select(split_url(F.col(url))[0].alias("source"), F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("target"))
    return links.withColumn("target", lower_ascii(F.col("target"))).where("source <> target and source <> ''").groupBy("source", "target").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) of the hosts that either reaches. seeds: (host, kind), kind t or d."""
    edges = scratch.table(edges, "edges")
    out = edges.groupBy("source").agg(F.sum("links").alias("total"))
    into = edges.groupBy(F.col("target").alias("to_host")).agg(F.sum("links").alias("total"))
    part = (F.col("links") / F.col("total")).alias("part")
    forward = edges.join(out, "source").select(F.lit("t").alias("kind"), F.col("source").alias("from"), F.col("target").alias("to"), part)
    back = edges.join(into, edges["target"] == into["to_host"]).select(F.lit("d").alias("kind"), F.col("target").alias("from"), F.col("source").alias("to"), part)
    steps = scratch.table(forward.union(back), "steps")
    seeds = seeds.distinct()
    count = seeds.groupBy("kind").agg(F.count("*").alias("n"))  # two rows
    seeds = scratch.table(seeds.join(F.broadcast(count), "kind").select("host", "kind", (1 / F.col("n")).alias("score")), "seeds")
    home = seeds.select("host", "kind", (F.col("score") * (1 - damping)).alias("score"))
    scores, moving, i = seeds, True, 0
    while moving:
        moved = steps.join(scores, (steps["from"] == scores["host"]) & (steps["kind"] == scores["kind"]))
        moved = moved.select(F.col("to").alias("host"), steps["kind"], (F.col("score") * F.col("part") * damping).alias("score"))
        # what was is carried along with a minus, so that one sum gives the new score and the change
        was = scores.select("host", "kind", F.lit(0.0).alias("score"), F.col("score").alias("old"))
        new = moved.union(home).withColumn("old", F.lit(0.0)).unionByName(was).groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("old").alias("old"))
        new = scratch.table(new, f"scores-{i}")
        change = new.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0
        moving = change > tolerance and not (i == 0 and steps.isEmpty())  # without links the first round is the last
        scores = new.where("score > 0").select("host", "kind", "score")
        if i:
            scratch.drop(f"scores-{i - 1}")
        i += 1
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))
    return scores.groupBy("host").agg(of("t").alias("trust"), of("d").alias("distrust"))


def rule_seeds(rows: DataFrame) -> DataFrame:
    """(host, kind) of the hosts of which rules allow (t) or block (d) more than half of the pages. rows: host, said."""
    share = lambda verdict: F.count(F.when(F.col("said") == verdict, 1))
    hosts = rows.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), share("allow").alias("allowed"), share("block").alias("blocked"))
    kind = F.when(2 * F.col("allowed") > F.col("n"), "t").when(2 * F.col("blocked") > F.col("n"), "d")
    return hosts.select("host", kind.alias("kind")).where("kind is not null")


def judge(pages: DataFrame, rules=RULES, seeds: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every page. seeds: (host, kind), kind t for trusted and d for blocked hosts, beside those that the rules give."""
    scratch = Scratch(pages.sparkSession, "links")
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rules(F.col("host"), F.col("path"), rules)
    rows = scratch.table(rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said")), "rows")
    start = rule_seeds(rows)
    if seeds is not None:
        start = start.union(seeds.select(lower_ascii(F.col("host")), "kind"))
    scores = scratch.table(propagate(host_edges(pages, url, html), start, scratch), "scores")
    joined = rows.alias("r").join(scores.alias("s"), F.col("r.host") == F.col("s.host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > trust + 1e-12, "block").otherwise("allow")
    return joined.select("page_id", "r.host", "path", "rule", F.coalesce("said", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def oracle_sql(rules=RULES, seed_hosts: str = "SELECT NULL WHERE false", rounds: int = 12) -> str:
    """judge() in DuckDB's SQL, with as many rounds as are enough for short chains of links. seed_hosts: SQL of the blocked hosts of the seed table."""
    said, named = [], []
    for verdict, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = text.partition("/")
        fits = f"WHEN (host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash}{rest}') THEN"
        said.append(f"{fits} '{verdict}'")
        named.append(f"{fits} '{text}'")
    fold = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = LINK.replace("'", "''")
    steps = "".join(
        f""",
s{i} AS MATERIALIZED (SELECT host, kind, sum(score) AS score FROM (
  SELECT t.to_host AS host, t.kind, s.score * t.part * {DAMPING}::DOUBLE AS score FROM steps t JOIN s{i - 1} s ON s.host = t.from_host AND s.kind = t.kind
  UNION ALL SELECT host, kind, score * (1 - {DAMPING}::DOUBLE) FROM s0) GROUP BY ALL)"""
        for i in range(1, rounds + 1)
    )
    return f"""
WITH parsed AS (SELECT page_id, html, {fold(f"regexp_extract(coalesce(url, ''), '{URL}', 1)")} AS host, regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
rows_ AS (SELECT page_id, host, path, CASE {" ".join(named)} END AS rule, CASE {" ".join(said)} END AS said FROM parsed),
links AS (SELECT host AS source, {fold("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS target FROM parsed),
edges AS (SELECT source, target, count(*) AS n FROM links WHERE source <> target AND source <> '' GROUP BY ALL),
steps AS MATERIALIZED (
  SELECT 't' AS kind, source AS from_host, target AS to_host, n / sum(n) OVER (PARTITION BY source) AS part FROM edges
  UNION ALL SELECT 'd', target, source, n / sum(n) OVER (PARTITION BY target) FROM edges),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE said = 'allow') AS allowed, count(*) FILTER (WHERE said = 'block') AS blocked FROM rows_ WHERE host <> '' GROUP BY host),
seeds AS (SELECT host, 't' AS kind FROM hosts WHERE 2 * allowed > n UNION SELECT host, 'd' FROM hosts WHERE 2 * blocked > n UNION SELECT *, 'd' FROM ({seed_hosts})),
s0 AS MATERIALIZED (SELECT host, kind, 1.0::DOUBLE / count(*) OVER (PARTITION BY kind) AS score FROM seeds){steps},
scores AS (SELECT host, coalesce(sum(score) FILTER (WHERE kind = 't'), 0) AS trust, coalesce(sum(score) FILTER (WHERE kind = 'd'), 0) AS distrust FROM s{rounds} GROUP BY host)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.said, CASE WHEN coalesce(s.distrust, 0) > coalesce(s.trust, 0) + 1e-12 THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(s.trust, 0), 9) AS trust, round(coalesce(s.distrust, 0), 9) AS distrust
FROM rows_ r LEFT JOIN scores s ON s.host = r.host"""
