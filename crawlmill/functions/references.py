"""Character references, decoded in one pass from left to right as HTML parsers do."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character reference as HTML reads it: numbers and names, also without a semicolon.
REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32};?)"
# The names that most pages use; they are tried before the table of all names.
USUAL = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;")
_LAST = 0x10FFFF


def quoted(text: str) -> str:
    """A SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def applied(function: str, text: Column) -> Column:
    """A SQL function ``x -> …`` of a column; its text is parsed where it is used and built only once."""
    return F.get(F.call_function("transform", F.array(text), F.expr(function)), 0)


def _table() -> str:
    """The names of the standard with their characters, as one constant map."""
    split = lambda texts: f"split({quoted(chr(1).join(texts))}, '\\u0001')"
    return f"map_from_arrays({split(html5.keys())}, {split(html5.values())})"


def with_names(body: str) -> str:
    """SQL in which ``names`` stands for the table of names; :func:`decoding` needs it. It is long, so name it once."""
    return f"transform(array({_table()}), names -> {body})[0]"


def _character(number: str) -> str:
    """The character of a number as HTML reads it; empty for what is no character."""
    windows = ", ".join(quoted(bytes([n]).decode("cp1252", "ignore") or chr(n)) for n in range(128, 160))
    invalid = (
        f"{number} BETWEEN 1 AND 8 OR {number} = 11 OR {number} BETWEEN 14 AND 31 OR {number} = 127 "
        f"OR {number} BETWEEN 64976 AND 65007 OR {number} % 65536 >= 65534"
    )
    return (
        f"CASE WHEN {number} = 0 OR {number} BETWEEN 55296 AND 57343 OR {number} > {_LAST} THEN '�' "
        f"WHEN {number} BETWEEN 128 AND 159 THEN get(array({windows}), cast({number} - 128 AS int)) "
        f"WHEN {invalid} THEN '' ELSE decode(unhex(lpad(hex({number}), 8, '0')), 'UTF-32') END"
    )


@cache
def _one() -> str:
    """SQL of one reference ``r``: its character, or itself if it means nothing."""
    open_names = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
    usual = " ".join(f"WHEN {quoted('&' + n)} THEN {quoted(html5[n])}" for n in USUAL)
    # Zeros in front are no digits; longer numbers are beyond all characters.
    digits = "regexp_replace(r, '^&#[xX]?0*|;', '')"
    number = (
        f"transform(array({digits}), d -> CASE WHEN d = '' THEN 0L "
        f"WHEN r RLIKE '^&#[xX]' THEN CASE WHEN length(d) > 6 THEN {_LAST + 1}L ELSE cast(conv(d, 16, 10) AS bigint) END "
        f"WHEN length(d) > 7 THEN {_LAST + 1}L ELSE cast(d AS bigint) END)"
    )
    named = (
        f"transform(array(substr(r, 2)), n -> coalesce(try_element_at(names, n), "
        f"transform(array(regexp_extract(n, '^(?:{open_names})', 0)), "
        f"o -> try_element_at(names, o) || substr(n, length(o) + 1))[0], r))[0]"
    )
    return f"CASE r {usual} ELSE CASE WHEN startswith(r, '&#') THEN transform({number}, c -> {_character('c')})[0] ELSE {named} END END"


@cache
def decoding(text: str = "t") -> str:
    """SQL that decodes the references of ``text``, the name of a variable; ``names`` is another."""
    pattern = quoted(REFERENCE)
    return (
        f"CASE WHEN contains({text}, '&') THEN array_join(zip_with(split({text}, {pattern}, -1), "
        f"transform(regexp_extract_all({text}, {pattern}, 0), r -> {_one()}), (p, c) -> p || coalesce(c, '')), '') "
        f"ELSE {text} END"
    )


@cache
def _decoder() -> str:
    return f"t -> {with_names(decoding())}"


def decode_entities(text: Column) -> Column:
    """Decode all character references of a text."""
    return F.when(F.contains(text, F.lit("&")), applied(_decoder(), text)).otherwise(text)
