"""HTML expressions: page body, attribute values, content fingerprint.

The patterns use possessive quantifiers, so matching is linear in the length of the
page and needs no deep recursion, however long a page is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlmill.functions.markup import WHITESPACE, normal_form

# What is not closed reaches to the end of the page.
_COMMENT = r"<!--.*?(?:-->|\z)"
_NAME_END = r"(?=[\s/>])"
_SCRIPT_END = r".*?(?:</script\s*>|\z)"
_STYLE_END = r".*?(?:</style\s*>|\z)"
_RAW_TEXT = rf"<script{_NAME_END}{_SCRIPT_END}|<style{_NAME_END}{_STYLE_END}"
# Up to the end tag; end tags inside comments, scripts or styles do not count.
_HEAD = (
    rf"<head{_NAME_END}[^>]*+>"
    rf"(?:[^<]++|{_COMMENT}|{_RAW_TEXT}|<(?!/head{_NAME_END}))*+(?:</head[^>]*+>|\z)"
)
# The look-ahead passes over all other characters at the cost of one test each.
_MARKED = r"(?s)(?=<[!hHsS])(?i)"
# Comments, scripts and styles are matched first so that a "<head>" in them is text.
_HEAD_ONLY = rf"{_MARKED}(?:({_COMMENT}|{_RAW_TEXT})|{_HEAD})"
# For link extraction: the start tags of scripts and styles stay, their text goes.
_INVISIBLE = (
    rf"{_MARKED}(?:{_COMMENT}|{_HEAD}"
    rf"|(<script{_NAME_END}[^>]*+>){_SCRIPT_END}|(<style{_NAME_END}[^>]*+>){_STYLE_END})"
)
_BODY_TAG = rf"(?i)<body{_NAME_END}"

# Names and bare values hold no "<": a tag that is not closed ends where the next begins.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'<>][^\s<>]*+)"""


def strip(text: Column) -> Column:
    """Text without whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _attribute_pattern(attribute: str, tag: str = "[a-z][^\\s/>]*+") -> str:
    """Pattern whose group 1 is the (last) value of ``attribute`` in a start tag."""
    wanted = rf"{attribute}(?=[\s/>=])"
    other = rf"[\s/]*+(?!{wanted})[^\s/<>][^\s/<>=]*+(?:\s*+=\s*+{_VALUE}?+)?+"
    return (
        rf"(?is)<{tag}(?=[\s/])"
        rf"(?:(?:{other})*+[\s/]*+{wanted}(?:\s*+=\s*+)?+((?<=[=\s]){_VALUE}|))++"
    )


HREF = _attribute_pattern("href")
ONCLICK = _attribute_pattern("onclick")
IMG_SRC = _attribute_pattern("src", tag="img")


def page_body(html: Column) -> Column:
    """The page without its head."""
    return F.regexp_replace(html, _HEAD_ONLY, "$1")


def has_body(html: Column) -> Column:
    """Whether a ``body`` element is left once the head is gone."""
    return contains_body_tag(visible_markup(html))


def visible_markup(html: Column) -> Column:
    """The page without head, comments and script or style text."""
    return F.regexp_replace(html, _INVISIBLE, "$1$2")


def contains_body_tag(markup: Column) -> Column:
    return F.coalesce(markup.rlike(_BODY_TAG), F.lit(False))


def attribute_values(markup: Column, pattern: str) -> Column:
    """Raw attribute values (quotes included) in document order."""
    return F.regexp_extract_all(markup, F.lit(pattern), F.lit(1))


def unquote_value(raw: Column) -> Column:
    """Attribute value without its quotes."""
    quoted = raw.startswith('"') | raw.startswith("'")
    return F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)


def content_hash(html: Column) -> Column:
    """Fingerprint of a page's body, NULL if there is no page.

    Pages that differ in their head or in the spelling of their markup alone have the same: the body is
    hashed in its normal form (see :mod:`crawlmill.functions.markup`).
    """
    marked_up = F.contains(html, F.lit("<"))
    return F.md5(F.when(marked_up, normal_form(page_body(html))).otherwise(strip(html)))
