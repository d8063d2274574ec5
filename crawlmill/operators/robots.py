"""Robots rules, politeness decisions and sitemaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill import constants as C
from crawlmill.functions.html import strip
from crawlmill.functions.references import decode_entities
from crawlmill.functions.times import ntz, plus_seconds
from crawlmill.functions.urls import (
    path_of, percent_decode, percent_encode, site_of, with_canonical_url,
)
from crawlmill.limits import NO_LIMITS, Limits
from crawlmill.operators.discovery import first_discovery, storable, unseen_urls
from crawlmill.session import materialize

FETCH, DELAY, FORBIDDEN = "FETCH", "DELAY", "FORBIDDEN"

_LINE_ENDS = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# Kept lines are written as one letter and an encoded value:
# U user-agent, A allow, D disallow, C crawl-delay, R request-rate, B blank.
_ENTRY = r"(?m)(?:^U.*\n)++(?:^[ADCR].*\n)*+"
_HAS_RULES = r"(?m)^[ADCR]"
# Text up to the end tag; another start tag in between means that this one is not closed.
_LOC = r"(?is)<loc(?=[\s>])[^>]*+>([^<]*+(?:<(?!/?loc[\s>])[^<]*+)*+)</loc\s*>"
_ANY_AGENT = r"(?m)^U%2A$"
_EMPTY_AGENT = r"(?m)^U$"


def _comparable(decoded: Column) -> Column:
    """Decoded path text in the form in which rules and URLs are compared.

    Empty parameter, query and fragment markers vanish; slashes stay, everything else
    that is not unreserved is percent-encoded.
    """
    path = F.regexp_replace(
        F.regexp_extract(decoded, r"(?s)^([^?#]*)", 1), r"(^|/)([^/;]*+);$", "$1$2"
    )
    query = F.regexp_extract(decoded, r"(?s)^[^?#]*(\?[^#]+)", 1)
    fragment = F.regexp_extract(decoded, r"(?s)^[^#]*(#.+)$", 1)
    return F.replace(
        percent_encode(F.concat(path, query, fragment)), F.lit("%2F"), F.lit("/")
    )


def _line_token(line: Column) -> Column:
    text = strip(F.regexp_replace(line, r"(?s)#.*", ""))
    key = F.lower(strip(F.substring_index(text, ":", 1)))
    written = strip(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1))
    value = percent_decode(written)
    return (
        F.when(line == "", "B")
        .when(~F.contains(text, F.lit(":")), "")
        .when(key == "user-agent", F.concat(F.lit("U"), percent_encode(value)))
        # An empty Disallow allows everything.
        .when((key == "disallow") & (value != ""), F.concat(F.lit("D"), _comparable(value)))
        .when(key.isin("allow", "disallow"), F.concat(F.lit("A"), _comparable(value)))
        .when(key == "crawl-delay", F.concat(F.lit("C"), percent_encode(strip(value))))
        .when(key == "request-rate", F.lit("R"))
        .otherwise("")
    )


def robots_policies(sites: DataFrame, keep: Sequence[str] = ("domain",)) -> DataFrame:
    """Rules and crawl delay for any agent, per row of ``sites(robots_content, ...)``.

    Result: keep..., ``rules ARRAY<STRUCT<pos, allow, prefix>>`` in file order,
    ``crawl_delay`` (as written, NULL if missing) and ``delay`` (never 0). A missing or
    empty file allows everything. A robots file is one value of one row, so reading it
    needs no shuffle.

    A file is a list of entries, and an entry is a run of user-agent lines followed at
    once by a run of rules; written one kept line per line, that is a regular expression.
    The entry that counts is the first one with rules and an empty agent name, else the
    first one with rules for ``*``.
    """
    text = F.regexp_replace(F.coalesce(F.col("robots_content"), F.lit("")), _LINE_ENDS, "\n")
    tokens = F.filter(F.transform(F.split(text, "\n", -1), _line_token), lambda t: t != "")
    runs = F.regexp_extract_all(F.col("_lines"), F.lit(_ENTRY), F.lit(0))
    entries = F.filter(runs, lambda e: e.rlike(_HAS_RULES))
    unnamed = F.filter(entries, lambda e: e.rlike(_EMPTY_AGENT) & ~e.rlike(_ANY_AGENT))
    anyone = F.filter(entries, lambda e: e.rlike(_ANY_AGENT))
    entry = F.coalesce(F.get(unnamed, F.lit(0)), F.get(anyone, F.lit(0)), F.lit(""))
    rules = F.transform(
        F.regexp_extract_all(F.col("_entry"), F.lit(r"(?m)^([AD].*)$"), F.lit(1)),
        lambda rule, pos: F.struct(
            pos.alias("pos"),
            rule.startswith("A").alias("allow"),
            F.substring(rule, F.lit(2), F.length(rule)).alias("prefix"),
        ),
    )
    delays = F.regexp_extract_all(F.col("_entry"), F.lit(r"(?m)^C([0-9]+)$"), F.lit(1))
    return (
        sites.select(*keep, F.concat(F.array_join(tokens, "\n"), F.lit("\n")).alias("_lines"))
        .select(*keep, entry.alias("_entry"))
        .select(
            *keep,
            rules.alias("rules"),
            _delay(F.try_element_at(delays, F.lit(-1))).alias("crawl_delay"),
        )
        .withColumn(
            "delay",
            F.coalesce(
                F.nullif(F.col("crawl_delay"), F.lit(0)), F.lit(C.DEFAULT_CRAWL_DELAY)
            ),
        )
    )


def _delay(digits: Column) -> Column:
    """Delay in seconds. What no int holds (68 years) stands for the largest one."""
    return F.when(digits.isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(2**31 - 1)))


def robots_rules(sites: DataFrame, keep: Sequence[str] = ("domain",)) -> DataFrame:
    """One row per rule: keep..., ``pos, allow, prefix``."""
    policies = robots_policies(sites, keep)
    return policies.select(*keep, F.explode("rules").alias("rule")).select(*keep, "rule.*")


def _robots_path(url: Column) -> Column:
    path = path_of(url)
    return F.when(path.rlike(r"^[A-Za-z0-9/._~-]*$"), path).otherwise(
        _comparable(percent_decode(path))
    )


#: Sites with more rules are asked by prefix. The rules of the others travel in one row.
MANY_RULES = 64


def robots_verdicts(
    urls: DataFrame, policies: DataFrame, carry: Sequence[str] = (), many: int = MANY_RULES
) -> DataFrame:
    """Add ``allowed``, ``delay`` and the policy columns ``carry`` to ``urls(url, domain, ...)``.

    The first rule in file order whose prefix fits decides; no rule allows. The rules of a
    site travel in one row, so a URL joins one row and no URL is multiplied. A site with more than
    ``many`` rules sends none of them: the paths of its URLs are cut to the lengths that its
    prefixes have, and these cuts meet the rules by equality, so the cost of a URL follows the number of
    lengths and not that of rules.

    No broadcast is forced: Spark takes one only if the policies are measured to be small.
    Otherwise it splits a hot domain of URLs (adaptive skew join), which needs plain
    shuffles on both sides: read the policies from a table, do not group them by domain
    in the same plan.
    """
    long = policies.where(F.size("rules") > many)
    if long.isEmpty():
        return _verdicts_by_row(urls, policies, carry).drop("_path")
    is_long = F.coalesce(F.size("rules") > many, F.lit(False))
    short = policies.withColumns({"_long": is_long, "rules": F.when(~is_long, F.col("rules"))})
    found = materialize(_verdicts_by_row(urls, short, [*carry, "_long"]), "verdicts")
    asked = found.where("_long")
    verdicts = materialize(_verdicts_by_prefix(asked.select("domain", "_path").distinct(), long), "prefix-verdicts")
    decided = asked.drop("allowed").join(verdicts, ["domain", "_path"], "left").withColumn(
        "allowed", F.coalesce("_allow", F.lit(True))
    )
    rest = found.where(~F.coalesce("_long", F.lit(False)))
    columns = [c for c in found.columns if c not in ("_path", "_long")]
    return rest.select(*columns).unionByName(decided.select(*columns))


def _verdicts_by_row(urls: DataFrame, policies: DataFrame, carry: Sequence[str]) -> DataFrame:
    """URLs with their verdict from the rules in the row of their site, and ``_path``."""
    joined = (
        urls.withColumn("_path", _robots_path(F.col("url")))
        .join(policies.select("domain", "rules", "delay", *carry), "domain", "left")
    )
    fitting = F.filter(
        F.col("rules"), lambda rule: F.startswith(F.col("_path"), rule["prefix"])
    )
    return (
        joined.withColumn("allowed", F.coalesce(F.get(fitting, F.lit(0))["allow"], F.lit(True)))
        .withColumn("delay", F.coalesce(F.col("delay"), F.lit(C.DEFAULT_CRAWL_DELAY)))
        .drop("rules")
    )


def _verdicts_by_prefix(paths: DataFrame, policies: DataFrame) -> DataFrame:
    """``domain, _path, _allow`` for the paths that a rule fits; rules with one prefix are one row."""
    rules = policies.select("domain", F.explode("rules").alias("_rule"))
    index = rules.groupBy("domain", F.col("_rule.prefix").alias("_prefix")).agg(
        F.min(F.struct("_rule.pos", "_rule.allow")).alias("_first")
    )
    lengths = policies.select(
        "domain", F.array_distinct(F.transform("rules", lambda rule: F.length(rule["prefix"]))).alias("_lengths")
    )
    path = F.col("_path")
    cuts = F.transform(
        F.filter("_lengths", lambda size: size <= F.length(path)), lambda size: F.substring(path, F.lit(1), size)
    )
    asked = paths.join(lengths, "domain").select("domain", "_path", F.explode(cuts).alias("_prefix"))
    met = asked.join(materialize(index, "rules-by-prefix"), ["domain", "_prefix"])
    return met.groupBy("domain", "_path").agg(F.min("_first").alias("_first")).select(
        "domain", "_path", F.col("_first.allow").alias("_allow")
    )


def with_current_robots(sites: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """Site rows with ``first_visit`` and the robots text that holds from now on.

    A site without robots text is visited for the first time; its text comes from
    ``fetched(domain, robots_content, sitemap_content)``. Of several texts for a domain the
    least one counts, so that a repeated job decides alike. A missing file becomes the empty
    text, which allows everything.
    """
    first_visit = F.col("robots_content").isNull()
    if fetched is None:
        return sites.withColumns({
            "first_visit": first_visit,
            "robots_content": F.coalesce("robots_content", F.lit("")),
        })
    texts = F.min(F.struct("robots_content", "sitemap_content")).alias("_texts")
    new = fetched.groupBy("domain").agg(texts).select(
        "domain",
        F.col("_texts.robots_content").alias("_robots"),
        F.col("_texts.sitemap_content").alias("_sitemap"),
    )
    return (
        sites.join(new, "domain", "left")
        .withColumn("first_visit", first_visit)
        .withColumns({
            "robots_content": F.coalesce("robots_content", "_robots", F.lit("")),
            "sitemap_content": F.when(F.col("first_visit"), F.col("_sitemap")).otherwise(
                F.col("sitemap_content")
            ),
        })
        .drop("_robots", "_sitemap")
    )


def site_states(current_sites: DataFrame) -> DataFrame:
    """Policies next to the stored state: ``first_visit``, ``next_acces``, ``delay``.

    The delay is read from the robots text on the first visit and stored from then on.
    """
    stored = current_sites.withColumn("stored_delay", F.col("delay").cast("int"))
    policies = robots_policies(
        stored, ("domain", "first_visit", "next_acces", "stored_delay")
    )
    delay = F.when(F.col("first_visit"), F.col("delay")).otherwise(
        F.coalesce(F.col("stored_delay"), F.col("delay"))
    )
    return policies.withColumn("delay", delay).drop("stored_delay", "crawl_delay")


def fetch_decisions(urls: DataFrame, states: DataFrame, as_of: datetime) -> DataFrame:
    """Add ``decision`` to ``urls(url, domain, ...)``: FETCH, DELAY or FORBIDDEN.

    Forbidden comes first; the first visit of a site does not wait; later visits wait
    for ``next_acces``.
    """
    timed = robots_verdicts(urls, states, carry=("first_visit", "next_acces"))
    ready = F.col("next_acces").isNull() | (ntz(as_of) >= F.col("next_acces"))
    decision = (
        F.when(~F.col("allowed"), FORBIDDEN)
        .when(F.coalesce(F.col("first_visit"), F.lit(True)) | ready, FETCH)
        .otherwise(DELAY)
    )
    return timed.withColumn("decision", decision)


def site_update(decisions: DataFrame, as_of: datetime) -> DataFrame:
    """New values of the visited sites: ``domain, next_acces, delay``.

    Each fetched page moves the next access by one delay, so n pages of a site move it by n
    delays. The first visit moves it by one at least, whatever the verdict. The decisions
    carry the state of their site, so one aggregation is enough, and it reduces a site to
    one row per task before the shuffle.
    """
    visits = decisions.where(F.col("first_visit").isNotNull()).groupBy("domain").agg(
        F.count_if(F.col("decision") == FETCH).alias("_fetched"),
        *[F.any_value(c).alias(c) for c in ("first_visit", "next_acces", "delay")],
    )
    visited = F.greatest("_fetched", F.col("first_visit").cast("long"))
    return visits.select(
        "domain",
        F.when(visited > 0, plus_seconds(ntz(as_of), visited * F.col("delay")))
        .otherwise(F.col("next_acces")).alias("next_acces"),
        "delay",
    )


def sitemap_url(robots_content: Column) -> Column:
    """Location of the sitemap: the first directive, without trailing blanks."""
    return F.nullif(
        strip(F.regexp_extract(robots_content, C.SITEMAP_DIRECTIVE, 1)), F.lit("")
    )


def accepted_sitemaps(responses: DataFrame) -> DataFrame:
    """Sitemap responses that count: status 200 only."""
    return responses.where(F.col("status") == 200)


def sitemap_locs(sitemaps: DataFrame, keep: Sequence[str] = ("domain",)) -> DataFrame:
    """All ``loc`` texts of ``sitemaps(sitemap_content, ...)``: keep..., ``pos, loc``.

    A sitemap index is read like any sitemap. Broken XML does no harm.
    """
    found = F.regexp_extract_all(F.col("sitemap_content"), F.lit(_LOC), F.lit(1))
    plain = F.regexp_replace(F.col("col"), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    return sitemaps.select(*keep, F.posexplode(found)).select(
        *keep, "pos", decode_entities(plain).alias("loc")
    )


def sitemap_urls(
    sitemaps: DataFrame, search_domains: Sequence[str] = (), keep: Sequence[str] = ("domain",)
) -> DataFrame:
    """Canonical sitemap URLs in scope: keep..., ``pos, url``.

    Relative locations belong to the requesting site, over ``scheme`` if there is such a
    column and http otherwise.
    """
    locs = sitemap_locs(sitemaps, keep)
    if "scheme" not in keep:
        locs = locs.withColumn("scheme", F.lit("http"))
    resolved = with_canonical_url(locs, "loc", "scheme", "domain", search_domains)
    return resolved.select(
        *keep, "pos",
        # A generator instead of a filter keeps the projections from running twice.
        F.explode(F.when(F.col("url").isNotNull(), F.array("url"))).alias("url"),
    )


def sitemap_frontier(
    sitemaps: DataFrame,
    known_pages: DataFrame,
    as_of: datetime,
    search_domains: Sequence[str] = (),
    order: Sequence[str] = ("domain",),
    limits: Limits = NO_LIMITS,
) -> DataFrame:
    """New pages from sitemaps: ``url, site_domain, url_host``, frontier values, order columns.

    ``sitemaps`` may be responses: with a column ``status`` only those of status 200 count.
    The page belongs to the requesting site even if its host is another one. Sitemap
    pages have no parent, so there are no links.
    """
    own = [c for c in order if c != "domain"]
    accepted = accepted_sitemaps(sitemaps) if "status" in sitemaps.columns else sitemaps
    urls = storable(sitemap_urls(accepted, search_domains, ["domain", *own]), limits)
    ranked = first_discovery(urls, [*order, "pos"])
    return unseen_urls(ranked, known_pages).select(
        "url",
        F.col("domain").alias("site_domain"),
        site_of(F.col("url")).alias("url_host"),
        F.lit("FRONTIER").alias("page_type_code"),
        ntz(as_of).alias("accessed_time"),
        ntz(as_of).alias("time_added"),
        *own, "pos",
    )
