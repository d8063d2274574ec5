"""One way to write a page: a tokenizer and the normal form of its tokens.

A page is cut into tokens by one possessive pattern, linear in its length. Each token is written in its normal
form on its own: tag and attribute names in lower case, values decoded and in double quotes, void tags as
``<br/>``, self-closed other tags with their end tag, references decoded and only ``&``, ``<``, ``>`` written
as such, whitespace at both ends of a text left out. Comments, CDATA sections and ``<?…>`` stay as they are, and so
does the text of scripts and styles. A ``pre`` or ``textarea`` is one token whose inner tokens keep their
whitespace.

Two pages have the same normal form if they differ only in these spellings; nesting is not looked at.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column

from crawlmill.functions.references import applied, decoding, quoted, with_names

# Elements without content.
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta",
    "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex",
    "nextid", "spacer",
)

# Whitespace of any kind, as text trimming understands it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'<>][^\s<>]*+)"""
_ATTRIBUTE = rf"[^\s/<>=][^\s/<>=]*+(?:\s*+=\s*+{_VALUE}?+)?+"
_START = rf"<[a-zA-Z][^\s/<>]*+(?:[\s/=]++|{_ATTRIBUTE})*+>?+"
_END = r"</[a-zA-Z][^<>]*+>?+"
_KEPT = r"<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?[^>]*+(?:>|\z)"
_DECLARATION = r"<![^<>]*+>?+"
_TEXT = r"(?:[^<]++|<(?![a-zA-Z/!?]))++"


def _block(names: str) -> str:
    """An element whose content is not cut; it ends with its end tag or with the page."""
    return rf"(?=<(?:{names})[\s/>]){_START}.*?(?:</(?:{names})\s*+>|\z)"


_RAW, _SPACED = _block("(?i:script|style)"), _block("(?i:pre|textarea)")
_SIMPLE = rf"{_END}|{_START}|{_DECLARATION}|{_TEXT}|<"
_INNER = rf"(?s){_KEPT}|{_SIMPLE}"
TOKEN = rf"(?s){_KEPT}|{_RAW}|{_SPACED}|{_SIMPLE}"

# SQL below: every function of Python gives the text of an expression over named variables, which is parsed once
# for a page. An expression of columns would be built anew for each token rule and each use.

_VOIDS = ", ".join(map(quoted, VOID))


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {quoted(pattern)}, 0)"


def _written(text: str) -> str:
    """Text with its references in one spelling.

    Most texts have nothing to decode or to write, and many have no references but those that stay.
    """
    escaped = "replace(replace(replace(d, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    bare = "NOT (contains(x, '&') OR contains(x, '<') OR contains(x, '>'))"
    done = f"NOT x RLIKE {quoted('[<>]|&(?!(?:amp|lt|gt);)')}"
    return _let("x", text, f"CASE WHEN {bare} THEN x WHEN {done} THEN x ELSE {_let('d', decoding('x'), escaped)} END")


def _stripped(text: str) -> str:
    return f"btrim({text}, {quoted(WHITESPACE)})"


def _name(tag: str) -> str:
    return f"lower(regexp_extract({tag}, {quoted(r'^</?([a-zA-Z][^\s/<>]*)')}, 1))"


def _attribute(source: str) -> str:
    """(name, written) of one attribute."""
    value = f"regexp_replace({source}, {quoted(r'^[^\s/<>=]+(?:\s*=\s*)?')}, '')"
    bare = "CASE WHEN v RLIKE '^[\"\\']' THEN substr(v, 2, length(v) - 2) ELSE v END"
    text = f"replace({_written(_let('v', value, bare))}, '\"', '&quot;')"
    name = f"lower(regexp_extract({source}, {quoted(r'^[^\s/<>=]+')}, 0))"
    return _let("n", name, f"named_struct('name', n, 'written', ' ' || n || '=\"' || {text} || '\"')")


def _start_tag(tag: str) -> str:
    """Of attributes with one name the last counts, at the place of the first."""
    found = _all(f"regexp_replace({tag}, {quoted(r'^<[^\s/<>]+')}, '')", _ATTRIBUTE)
    names = "transform(a, p -> p.name)"
    once = f"transform(array_distinct({names}), q -> element_at(filter(a, p -> p.name = q), -1))"
    some = f"CASE WHEN size(array_distinct({names})) < size(a) THEN {once} ELSE a END"
    listed = _let("a", f"transform(f, s -> {_attribute('s')})", f"array_join(transform({some}, p -> p.written), '')")
    # A slash at the end of a bare value belongs to the value.
    tail = quoted("=\\s*[^\\s\"'][^\\s]*/$")
    closed = f"endswith({tag}, '/>') AND NOT coalesce(get(f, size(f) - 1) RLIKE {tail}, false)"
    end = f"CASE WHEN m IN ({_VOIDS}) THEN '/>' WHEN {closed} THEN '></' || m || '>' ELSE '>' END"
    return _let("f", found, _let("m", _name(tag), f"'<' || m || {listed} || {end}"))


def _simple(token: str, text: str) -> str:
    """Normal form of a token that is no block; ``text`` is that of a text."""
    plain = quoted("^</?[a-z][a-z0-9]*>$")
    starts, ends = (", ".join(quoted(f"<{sign}{n}>") for n in VOID) for sign in ("", "/"))
    return (
        f"CASE WHEN NOT startswith({token}, '<') THEN {text} "
        f"WHEN {token} RLIKE {plain} THEN CASE WHEN {token} IN ({starts}) THEN replace({token}, '>', '/>') "
        f"WHEN {token} IN ({ends}) THEN '' ELSE {token} END "
        f"WHEN startswith({token}, '<!--') OR startswith({token}, '<![CDATA[') OR startswith({token}, '<?') THEN {token} "
        f"WHEN startswith({token}, '<!') THEN regexp_replace({token}, {quoted(r'(?i)^<!doctype\s+')}, '<!doctype ') "
        f"WHEN {token} RLIKE '^</[a-zA-Z]' THEN {_let('m', _name(token), f"CASE WHEN m IN ({_VOIDS}) THEN '' ELSE '</' || m || '>' END")} "
        f"WHEN {token} RLIKE '^<[a-zA-Z]' THEN {_start_tag(token)} ELSE {text} END"
    )


def _block_form(token: str) -> str:
    """A block: its start tag, its content, and its end tag even if the page ends before it."""
    start = f"regexp_extract({token}, {quoted(f'(?s)^{_START}')}, 0)"
    content = f"regexp_replace(substr({token}, length(b) + 1), {quoted(r'(?is)</(?:script|style|pre|textarea)\s*>$')}, '')"
    inner = f"array_join(transform({_all('c', _INNER)}, i -> {_simple('i', _written('i'))}), '')"
    body = _let("c", content, f"CASE WHEN e IN ('script', 'style') THEN {_stripped('c')} ELSE {inner} END")
    return _let("b", start, _let("e", _name(token), f"{_start_tag('b')} || {body} || '</' || e || '>'"))


@cache
def _normal_form() -> str:
    block = quoted(r"^<(?i:script|style|pre|textarea)[\s/>]")
    form = f"CASE WHEN startswith(t, '<') AND t RLIKE {block} THEN {_block_form('t')} ELSE {_simple('t', _written(_stripped('t')))} END"
    written = f"array_join(transform({_all('page', TOKEN)}, t -> {form}), '')"
    return f"page -> {with_names(written)}"


def normal_form(page: Column) -> Column:
    """The page in normal form (see the module); NULL stays NULL."""
    return applied(_normal_form(), page)
