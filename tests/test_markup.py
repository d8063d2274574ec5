"""The normal form of pages against the standard library's parser."""

import html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from crawlmill.functions import html as H
from crawlmill.functions.markup import VOID, WHITESPACE, normal_form
from crawlmill.functions.references import decode_entities


class Writer(HTMLParser):
    """The normal form as the parser's events give it."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out, self.text, self.keeps = [], "", None

    def flush(self):
        text = html.unescape(self.text) if self.keeps not in ("script", "style") else self.text
        if self.keeps not in ("pre", "textarea"):
            text = self.stripped(self.text)
            text = html.unescape(text) if self.keeps not in ("script", "style") else text
        self.out.append(text if self.keeps in ("script", "style") else html.escape(text, quote=False))
        self.text = ""

    @staticmethod
    def stripped(text):
        return text.strip(WHITESPACE)

    def handle_starttag(self, tag, attrs, closed=False):
        self.flush()
        kept = {}
        for name, value in attrs:
            kept[name] = value or ""
        listed = "".join(f' {n}="{html.escape(v, quote=False).replace(chr(34), "&quot;")}"' for n, v in kept.items())
        self.out.append(f"<{tag}{listed}" + ("/>" if tag in VOID else f"></{tag}>" if closed else ">"))
        if tag in ("pre", "textarea", "script", "style") and not closed:
            self.keeps = tag

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        self.flush()
        self.keeps = None if tag == self.keeps else self.keeps
        self.out.append("" if tag in VOID else f"</{tag}>")

    def handle_data(self, data):
        self.text += data

    def handle_entityref(self, name):
        raise AssertionError("references are read from the text")

    def handle_comment(self, data):
        self.flush()
        self.out.append(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.flush()
        self.out.append("<!doctype " + decl[7:].strip() + ">")

    def handle_pi(self, data):
        self.flush()
        self.out.append(f"<?{data}>")


def parsed(page):
    """References are set aside, so that the parser reports texts in one piece."""
    writer = Writer()
    writer.handle_charref = lambda name: writer.handle_data(f"&#{name};")
    writer.handle_entityref = lambda name: writer.handle_data(f"&{name};")
    writer.feed(page)
    writer.close()
    writer.flush()
    return "".join(writer.out)


TEXTS = ["a", " b ", "\n", "x &amp; y", "&lt;i&gt;", "1 < 2 ", "é&eacute;", "&copy; &#233;", " z", "q\"'", "&#38;lt;"]
NAMES = ["p", "P", "div", "B", "li", "a", "h1", "custom-tag"]
VALUES = ['"v"', "'v'", "v", '"a b"', "'say \"x\"'", '"&amp;&lt;"', '"a>b"', "/x/y?z=1", '""', "'&eacute;'"]


def random_page(draw):
    out = []
    for _ in range(draw.randrange(1, 12)):
        kind = draw.randrange(9)
        blank = lambda: draw.choice(["", " ", "\n"])
        attributes = "".join(
            f"{draw.choice([' ', chr(10), '  '])}{draw.choice(['id', 'CLASS', 'data-x', 'href'])}"
            + draw.choice(["", f"{blank()}={blank()}{draw.choice(VALUES)}"]) for _ in range(draw.randrange(3)))
        if kind < 3:
            out.append(draw.choice(TEXTS))
        elif kind == 3:
            out.append(f"<{draw.choice(NAMES)}{attributes}{draw.choice(['', ' '])}>")
        elif kind == 4:
            out.append(f"</{draw.choice(NAMES)}{blank()}>")
        elif kind == 5:
            out.append(f"<{draw.choice(['br', 'BR', 'img', 'hr'])}{attributes}{draw.choice([' ', ' /', ''])}>")
        elif kind == 6:
            out.append(draw.choice(["<!-- c <p> -->", "<?php x ?>", "<!DOCTYPE html>", "<!doctype  html>"]))
        elif kind == 7:
            name = draw.choice(["script", "STYLE", "Script"])
            out.append(f"<{name}{attributes}> var a = '<p>' &amp; 1; </{name}>")
        else:
            name = draw.choice(["pre", "PRE", "textarea"])
            out.append(f"<{name}{attributes}> x <b>y</b>\n&amp; </{name}>")
    return "".join(out)


def forms(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, page string").repartition(4)
    return [r[1] for r in sorted(df.select("id", normal_form(F.col("page"))).collect())]


def test_random_markup_equals_a_parser(spark):
    draw = random.Random(8)
    pages = [random_page(draw).replace("<textarea", "<pre").replace("</textarea", "</pre") for _ in range(1500)]
    for page, form in zip(pages, forms(spark, pages)):
        assert form == parsed(page), page


def test_the_normal_form_is_stable(spark):
    draw = random.Random(9)
    pages = [random_page(draw) for _ in range(500)]
    once = forms(spark, pages)
    assert forms(spark, once) == once


SAME = [
    "<body><p class=\"a\">x &amp; y<br>é</p></body>", "<BODY><P CLASS='a'>x &#38; y<BR/>&eacute;</P></BODY>",
    "<body ><p class = a>x & y<br />&#xE9;</p\n></body>", "<body><p class=a >\n x &amp y<br></br>é </p> </body>",
    "<body>\n<p\tclass=\"&#97;\">x &AMP; y<Br>&#233;</p></body>",
]


def test_five_spellings_of_two_pages_have_two_hashes(spark):
    pages = SAME + [page.replace("<p", "<b").replace("<P", "<b").replace("</P", "</b").replace("</p", "</b") for page in SAME]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    found = dict(map(tuple, df.select("id", H.content_hash(F.col("html"))).collect()))
    assert len({found[i] for i in range(5)}) == len({found[i] for i in range(5, 10)}) == 1 and found[0] != found[5]


def test_sections_that_are_no_markup(spark):
    given = ["<![CDATA[ <p>&amp;</p> ]]>x", "<![CDATA[ open <p>", "<?xml a='<'?>", "a < b <3 c", "<", "</", "<>", "", "<p", "<a href='x", "<!--", "<pre> x"]
    found = forms(spark, given)
    assert found[:3] == [given[0], given[1], given[2]]
    assert found[3] == "a &lt; b &lt;3 c" and found[4] == "&lt;" and found[7] == "" and found[8] == "<p>" and found[-1] == "<pre> x</pre>"


@pytest.mark.parametrize("piece", ["<p ", "<a b=", "<", "&", "<!--", "<pre>", "<br>x", "'\"", "=", "</", "<script>"])
def test_long_repeats_end(spark, piece):
    page = piece * (200_000 // len(piece))
    assert forms(spark, [page])[0] is not None


def test_references_equal_the_standard_decoder(spark):
    draw = random.Random(1)
    parts = ["&", "#", "x", "amp", "lt", ";", "1", "9", "f", " ", "copy", "not", "in", "&#", "&#x", "D800", "128", "\n"]
    texts = ["".join(draw.choice(parts) for _ in range(12)) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    for text, found in df.select("t", decode_entities(F.col("t"))).collect():
        assert found == html.unescape(text), text
