"""HTML helpers.

Head metadata and anchors are read with native regular expressions (JVM-side, whole-stage codegen).
Class-scoped body text needs a real tokenizer (unclosed tags, `</p>` inside scripts), so that part is
a small stdlib `html.parser` helper run inside `mapInPandas` over Arrow batches.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five character references decoded in attribute/title text read by regex.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def title_text(html: Column) -> Column:
    return unescape(F.regexp_extract(html, r"<title[^>]*>([^<]*)</title>", 1))


def tags(html: Column, name: str) -> Column:
    """All start tags of an element, as an array; attribute values may hold '>'."""
    return F.regexp_extract_all(html, F.lit(rf"""(?is)<{name}\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, quoted either way or bare; '' when absent."""
    found = F.regexp_extract(tag, rf"""(?is)\s{re.escape(name)}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return unescape(F.regexp_replace(found, r"""(?s)^(["'])(.*)\1$""", "$2"))


def meta_fields(html: Column, *attrs: str) -> Column:
    """Per <meta> tag a struct of the lower-cased values of `attrs` and its content: each tag is read once."""
    return F.transform(tags(html, "meta"), lambda t: F.struct(*[F.lower(attribute(t, a)).alias(a) for a in attrs], attribute(t, "content").alias("content")))


def meta_of(metas: str, attr: str, value: str) -> Column:
    """content of the first of the column `metas` (made by `meta_fields`) whose `attr` is `value` ('' when absent)."""
    return F.coalesce(F.get(F.filter(metas, lambda t: t[attr] == value.lower()), 0)["content"], F.lit(""))


def text_of(fragment: Column) -> Column:
    """The text of a piece of markup: tags out, character references decoded, white space as one blank."""
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(fragment, r"(?s)<[^>]*>", " ")), r"\s+", " "))


def html_lang(html: Column) -> Column:
    return attribute(F.regexp_extract(html, r"(?is)<html\b[^>]*>", 0), "lang")


# An anchor (1: its start tag, 2: what is inside), the same with all up to the next anchor, and a date in either.
ANCHOR = r"(?is)(<a\b[^>]*>)(.*?)</a>"
ANCHOR_AND_AFTER = r"(?is)<a\b[^>]*>.*?</a>(?:(?!<a\b).)*+"
TIME = r"""(?is)<(?:time\b[^>]*|[a-z]+\b[^>]*\bclass\s*=\s*["']?[^"'>]*\btimestamp\b[^>]*)>(.*?)</"""

# ---------------------------------------------------------------- class-scoped text (Python helper)

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "section", "article"}
_SKIP = {"script", "style", "noscript", "template"}


class _Scoped(HTMLParser):
    """Collects the text inside elements selected by tag+exact class or by any class token."""

    def __init__(self, selectors):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors        # list of (tag or None, class token or None, exact class or None)
        self.stack: list[tuple[str, bool]] = []
        self.capture = 0
        self.skip = 0
        self.parts: list[str] = []
        self.metas: dict[tuple[str, str], str] = {}

    def _match(self, tag, attrs):
        cls = attrs.get("class") or ""
        tokens = cls.split()
        for s_tag, token, exact in self.selectors:
            if s_tag and s_tag != tag:
                continue
            if exact is None and token is None:
                return True
            if exact is not None and cls == exact:
                return True
            if token is not None and token in tokens:
                return True
        return False

    def handle_starttag(self, tag, attrs_list):
        attrs = dict(attrs_list)
        if tag == "meta":
            for key in ("name", "property"):
                if key in attrs and "content" in attrs:
                    self.metas.setdefault((key, attrs[key]), attrs["content"] or "")
        if tag in _VOID:
            if tag == "br" and self.capture:
                self.parts.append("\n")
            return
        if tag in _SKIP:
            self.skip += 1
        hit = self._match(tag, attrs)
        if hit:
            if self.capture == 0 and self.parts:
                self.parts.append("\n")
            self.capture += 1
        elif self.capture and tag in _BLOCK:
            self.parts.append("\n")
        self.stack.append((tag, hit))

    def handle_endtag(self, tag):
        # close up to the matching open tag (tolerates unclosed children such as <p><b>)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for t, hit in self.stack[i:]:
                    if hit:
                        self.capture -= 1
                    if t in _SKIP:
                        self.skip -= 1
                del self.stack[i:]
                break
        if self.capture and tag in _BLOCK:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.capture and not self.skip:
            self.parts.append(data)

    def text(self) -> str:
        raw = "".join(self.parts)
        lines = [" ".join(line.split()) for line in raw.split("\n")]
        return "\n".join(line for line in lines if line)


def by_tag(tag: str):
    return [(tag, None, None)]


def by_class(*tokens: str):
    """Elements having any of the class tokens (CSS `.a, .b`)."""
    return [(None, t, None) for t in tokens]


def by_exact_class(tag: str, value: str):
    """`tag` elements whose class attribute is exactly `value` (CSS `tag[class="value"]`)."""
    return [(tag, None, value)]


def scoped_text(html: str | None, selector) -> str:
    """Text of the elements matched by `selector` ('' when none or when html is empty)."""
    return scoped_texts_and_metas(html, {"": selector})[0][""]


def scoped_texts_and_metas(html: str | None, selectors: dict):
    """One parse of the page: text per named selector, plus the page's <meta> name/property values.
    The parser reads any markup, however malformed, without raising."""
    if not html:
        return {k: "" for k in selectors}, {}
    parsers = {k: _Scoped(v) for k, v in selectors.items()}
    fan = _Fan(list(parsers.values()))
    fan.feed(html)
    fan.close()
    return {k: p.text() for k, p in parsers.items()}, next(iter(parsers.values())).metas


class _Fan(HTMLParser):
    """Feeds one tokenisation of a page to several scoped collectors."""

    def __init__(self, parsers):
        super().__init__(convert_charrefs=True)
        self.parsers = parsers

    def handle_starttag(self, tag, attrs):
        for p in self.parsers:
            p.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for p in self.parsers:
            p.handle_endtag(tag)

    def handle_data(self, data):
        for p in self.parsers:
            p.handle_data(data)
