"""URL filters: fixed rules first, then trust and distrust that spread over the link graph of hosts.

Column expressions, joins and aggregations only.
"""

from __future__ import annotations

import functools
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.session import materialize

HOST = "^[^/?#]*"
PATH = "^[^/?#]*([^?#]*)"
#: Host of an absolute or scheme-relative link in an href attribute.
LINK = r"""(?i)href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x09-\x0D\x20]+)"""
DAMPING = 0.85
ITERATIONS = 20
CUT = 5  # iterations in one plan


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, rule: str) -> Rule:
        host, slash, path = rule.partition("/")
        return cls(verdict, host, slash + path)

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def _lower(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    place = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(place > 0, url.substr(place + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_after_scheme(url), HOST, 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), PATH, 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none does."""
    longest_first = sorted(rules, key=lambda r: (-len(str(r)), str(r)))
    given = [F.when(r.fits(host, path), F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in longest_first]
    return functools.reduce(lambda a, b: F.coalesce(a, b), given) if given else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): which host links to which other host, each once."""
    links = pages.select(
        host_of(F.col(url_col)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("dst"),
    )
    return links.select("src", _lower(F.col("dst")).alias("dst")).filter("src <> '' and src <> dst").distinct()


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind of seed (kind, host).

    ``edges`` (kind, src, dst). Every seed starts with 1, which leaks at hosts without edges. A
    score is the sum over all paths from the seeds of up to ``iterations`` edges. Contributions are
    added up before the shuffle; every ``CUT`` iterations the scores are written.
    """
    degrees = edges.groupBy("kind", "src").agg((F.lit(damping) / F.count("*")).alias("share"))
    edges = materialize(edges.join(degrees, ["kind", "src"]), "host_edges")
    start = seeds.select("kind", "host", F.lit(1.0 - damping).alias("score"))
    scores = start
    if edges.isEmpty():
        return scores
    for step in range(1, iterations + 1):
        moved = scores.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
        moved = moved.select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share")).alias("score"))
        scores = start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % CUT == 0 or step == iterations:
            scores = materialize(scores, "host_scores")
    return scores


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict (allow or block).

    The longest rule that fits decides. Else the host does: a host of which more than half of the
    pages have an allowing rule is a trusted seed, and a blocked seed likewise. Trust follows links
    forward; distrust follows them backwards, to those who link to bad hosts. A host is blocked if
    its distrust exceeds its trust; a host that neither reaches is allowed. Urls that are null or
    have no ``://`` have host and path '' and no place in the graph, so they are allowed. An empty
    path starts with no rule's path. Null markup has no links. Repeated rows come out as they come
    in; other columns are not read; an empty table gives an empty result.
    """
    placed = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    judged = placed.withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.select("id", "host", "path", "judged.rule", F.col("judged.verdict").alias("given"))
    hosts = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("given") == "allow").alias("allow"), F.count_if(F.col("given") == "block").alias("block")
    )
    hosts = hosts.filter("2 * allow > pages or 2 * block > pages")
    seeds = materialize(
        hosts.select(F.when(F.expr("2 * allow > pages"), "trust").otherwise("distrust").alias("kind"), "host"), "seeds"
    )
    edges = materialize(host_edges(pages, url_col, html_col), "edges")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    scores = spread(both, seeds).groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    # The margin keeps sums that differ by rounding from deciding.
    blocked = materialize(
        scores.filter("distrust > trust * (1 + 1e-9)").select("host", F.lit("block").alias("by_host")), "blocked_hosts"
    )
    return judged.join(blocked, "host", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("given", "by_host", F.lit("allow")).alias("verdict"),
    )


def oracle_sql(rules: list[Rule]) -> str:
    """DuckDB SQL for the verdicts on a table ``pages``."""
    fits = {
        str(r): f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        for r in sorted(rules, key=lambda r: -len(str(r)))
    }
    verdicts = {str(r): r.verdict for r in rules}
    rule = "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in fits.items()) + " END"
    given = "CASE rule " + " ".join(f"WHEN '{name}' THEN '{verdict}'" for name, verdict in verdicts.items()) + " END"
    lower = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    link = LINK.replace("'", "''")
    steps = "".join(
        f""", r{i} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (
            SELECT kind, host, {1 - DAMPING} AS score FROM seeds
            UNION ALL SELECT e.kind, e.dst, r.score * e.share FROM r{i - 1} r JOIN edges e ON r.kind = e.kind AND r.host = e.src)
            GROUP BY ALL)"""
        for i in range(1, ITERATIONS + 1)
    )
    return f"""
    WITH cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    placed AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ruled AS (SELECT *, {rule} AS rule FROM placed),
    judged AS MATERIALIZED (SELECT *, {given} AS given FROM ruled),
    seeds AS MATERIALIZED (
        SELECT CASE WHEN 2 * count(*) FILTER (given = 'allow') > count(*) THEN 'trust' ELSE 'distrust' END AS kind, host
        FROM judged WHERE host <> '' GROUP BY host
        HAVING 2 * count(*) FILTER (given = 'allow') > count(*) OR 2 * count(*) FILTER (given = 'block') > count(*)),
    links AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst FROM judged),
    pairs AS (SELECT DISTINCT src, dst FROM links WHERE src <> '' AND src <> dst),
    both_ways AS (SELECT 'trust' AS kind, src, dst FROM pairs UNION ALL SELECT 'distrust', dst, src FROM pairs),
    edges AS MATERIALIZED (SELECT *, {DAMPING} / count(*) OVER (PARTITION BY kind, src) AS share FROM both_ways),
    r0 AS MATERIALIZED (SELECT kind, host, {1 - DAMPING} AS score FROM seeds){steps},
    blocked AS (SELECT host FROM r{ITERATIONS} GROUP BY host
        HAVING coalesce(sum(score) FILTER (kind = 'distrust'), 0) > coalesce(sum(score) FILTER (kind = 'trust'), 0) * (1 + 1e-9))
    SELECT page_id, host, path, rule, coalesce(given, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM judged
    """
