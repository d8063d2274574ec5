"""URL expressions: splitting, scope test, canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.constants import HTTP_SCHEMES, INDEX_PAGE

# RFC 3986, appendix B, one pattern per wanted part.
_SCHEME = r"^([^:/?#]+):"
_NETLOC = r"^(?:[^:/?#]+:)?//([^/?#]*)"
_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"

# A path of unreserved characters needs no encoding.
_PLAIN_PATH = r"^[A-Za-z0-9/._~-]*$"
_NEEDS_FOLDING = r"//|/\."
_REPLACEMENT_CHARACTER = "\ufffd"


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def url_scheme(url: Column) -> Column:
    """Lower-cased scheme, NULL if the text has none."""
    return _or_null(F.lower(F.regexp_extract(url, _SCHEME, 1)))


def url_netloc(url: Column) -> Column:
    """Network location as written (port kept), NULL if the text has none."""
    return _or_null(F.regexp_extract(url, _NETLOC, 1))


def url_path(url: Column) -> Column:
    """Path as written; query and fragment are not part of it."""
    return F.regexp_extract(url, _PATH, 1)


def site_of(canonical_url: Column) -> Column:
    """Site key (host and non-default port) of a canonical URL."""
    return F.split_part(canonical_url, F.lit("/"), F.lit(3))


def path_of(canonical_url: Column) -> Column:
    """Path of a canonical URL, without a regular expression."""
    start = F.length(F.substring_index(canonical_url, "/", 3)) + F.lit(1)
    return F.substring(canonical_url, start, F.length(canonical_url))


def in_scope(netloc: Column, search_domains: Sequence[str]) -> Column:
    """Whether a network location ends in one of the searched domains.

    The domains are used as pattern text and matched as a plain suffix, so dots are
    wild cards and no label boundary is required. An empty list accepts everything.
    """
    if isinstance(search_domains, str):
        raise TypeError("search_domains must be a list of domains")
    if not search_domains:
        return F.lit(True)
    return netloc.rlike("(" + "|".join(search_domains) + ")/?$")


def percent_decode(text: Column) -> Column:
    """Decode every valid %XX; stray percent signs and plus signs are text."""
    strays = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(strays, F.lit("+"), F.lit("%2B")))


def percent_encode(text: Column) -> Column:
    """Encode everything but unreserved characters, as UTF-8 with upper-case hex."""
    encoded = F.url_encode(text)
    for written, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(written), F.lit(wanted))
    return encoded


def _encode_segment(segment: Column) -> Column:
    """Canonical encoding of one path segment; applying it twice changes nothing.

    Escapes that are not UTF-8 cannot be decoded without loss. Such a segment keeps
    its escapes and only gets the remaining characters encoded.
    """
    decoded = percent_decode(segment)
    keep_escapes = F.regexp_replace(percent_encode(segment), r"%25([0-9A-Fa-f]{2})", r"%$1")
    return F.when(
        F.contains(decoded, F.lit(_REPLACEMENT_CHARACTER)), keep_escapes
    ).otherwise(percent_encode(decoded))


def encode_path(path: Column) -> Column:
    segments = F.transform(F.split(path, "/", -1), _encode_segment)
    return F.when(path.rlike(_PLAIN_PATH), path).otherwise(F.array_join(segments, "/"))


def fold_path(path: Column) -> Column:
    """Remove empty, ``.`` and ``..`` segments; a trailing slash stays."""
    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    joined = F.array_join(kept, "/")
    tail = F.when(path.endswith("/") & (joined != ""), "/").otherwise("")
    folded = F.concat(F.lit("/"), joined, tail)
    return F.when(path.rlike(_NEEDS_FOLDING), folded).otherwise(path)


def _canonical_host(scheme: Column, netloc: Column) -> Column:
    host = F.lower(netloc)
    return (
        F.when(scheme == "http", F.regexp_replace(host, r":80$", ""))
        .otherwise(F.regexp_replace(host, r":443$", ""))
    )


def with_canonical_url(
    df: DataFrame,
    raw: str,
    parent_scheme: str,
    parent_host: str,
    search_domains: Sequence[str] = (),
    out: str = "url",
    any_host: Column | None = None,
) -> DataFrame:
    """Add the canonical form of column ``raw`` as column ``out``.

    NULL marks text that is no crawlable URL (other scheme, out of scope). Parts that
    the text lacks come from the parent's scheme and host. Relative paths start at the
    site root, and query and fragment are dropped. ``search_domains`` looks at the
    network location as written; rows for which ``any_host`` holds skip that test.

    The work is laid out as a chain of projections so that each intermediate value is
    computed once per row.
    """
    rooted = F.regexp_replace(url_path(F.col(raw)), r"^(?!/)", "/")
    split = df.withColumns({
        "_scheme": F.coalesce(url_scheme(F.col(raw)), F.col(parent_scheme)),
        "_netloc": F.coalesce(url_netloc(F.col(raw)), F.col(parent_host)),
        "_path": F.regexp_replace(rooted, INDEX_PAGE, "/"),
    })
    encoded = split.withColumn("_path", encode_path(F.col("_path")))
    folded = encoded.withColumn("_path", fold_path(F.col("_path")))
    scope = in_scope(F.col("_netloc"), search_domains)
    if any_host is not None:
        scope = any_host | scope
    crawlable = F.col("_scheme").isin(*HTTP_SCHEMES) & scope
    canonical = F.concat(
        F.col("_scheme"), F.lit("://"),
        _canonical_host(F.col("_scheme"), F.col("_netloc")), F.col("_path"),
    )
    return folded.withColumn(out, F.when(crawlable, canonical)).drop(
        "_scheme", "_netloc", "_path"
    )
