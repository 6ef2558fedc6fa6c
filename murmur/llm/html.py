"""Main-text extraction by composite text density.

A page becomes a flat list of DOM nodes. Subtrees that are never article text (scripts, styles,
forms, navigation, and elements whose class, id or role names a menu, advert, notice, sidebar or
reader comments) are left out. For every other node the characters per tag are computed and adjusted
by the share of link text; a node's density sum adds up its children's densities. The node with the
largest sum is the heart of the article; the smallest density on its path up to the body is the
threshold, and from every node that reaches it, the subtree with the largest sum is content. Where the
heart lies in an `article` or `main`, the path ends there, and such an element is content as a whole if
it reaches the threshold.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import in_arrow

TAG = re.compile(r"<(?:!--(?:.*?--!?>|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names of the HTML standard, by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("script style textarea title noscript template iframe object embed canvas svg math audio video map head nav menu footer aside form button select input dialog noembed noframes xmp".split())
LANDMARKS = frozenset(["article", "main"])
# An element of the first kind is closed where one of the second opens.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]), "head": frozenset(["body"]),
}
CLOSES = {name: [below for below, closers in CLOSED_BY.items() if name in closers] for name in frozenset().union(*CLOSED_BY.values())}
SCOPES = frozenset(["table", "ul", "ol", "dl", "article", "section", "main", "body", "div", "td", "th", "blockquote"])

# Words in a class or id, and roles, of parts that are not the article's text.
PART = re.compile(r"ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w*|"
                  r"nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|toolbar|sidebar|side|widget|aside|share|sharing|social|related|recommend\w*|"
                  r"comments?|commentlist|replies|reply|respond|discussion|disqus|footer|masthead|site-header|page-header|topbar|login|signup|search|skip|hidden|disclaimer|copyright|paywall", re.I)
#: Words that say nothing about the kind of a part: the word before them counts.
PLAIN_WORDS = frozenset("area bar block body bottom box container content form group header holder inner item items left link links list main outer panel right row section slot title top wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
KEPT, NAMED, GONE = 0, 1, 2


def _class_part(value: str) -> int:
    """GONE where a class or id names a part, NAMED where a part's word is only one word of a compound
    such as `social-policy`: the densities decide on those."""
    found = KEPT
    for token in value.split():
        if PART.fullmatch(token):
            return GONE
        words = [w for w in re.split("[-_]+", token) if w]
        if not words or words[0].lower() in ("has", "with", "no"):
            continue
        kind = [w for w in words if w.lower() not in PLAIN_WORDS] or words
        if PART.fullmatch(kind[-1]):
            return GONE
        if any(PART.fullmatch(w) for w in words):
            found = NAMED
    return found


def _is_part(name: str, attributes: str, in_article: bool) -> int:
    if name in DROPPED or name == "header" and not in_article:
        return GONE
    if not attributes or attributes.isspace() or name in ("html", "body"):
        return KEPT
    found = KEPT
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value == "true" \
                or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) \
                or key in ("class", "id") and name in LANDMARKS and re.search(r"comment|related|promo|advert", value, re.I):
            return GONE
        if key in ("class", "id") and name not in LANDMARKS:
            found = max(found, _class_part(value))
            if found == GONE:
                return GONE
    return found


class Page:
    """Nodes as parallel lists in page order (a parent comes before its children), and text pieces."""

    def __init__(self, html: str):
        self.names, self.parents, self.dropped = ["#root"], [-1], [False]
        self.named, self.in_landmark = [False], [False]
        self.pieces: list[tuple[int, str]] = []  # (node, decoded text)
        self.stack = [0]
        self.places: dict[str, list[int]] = {}  # of each name the places in the stack
        self.scopes = [0]
        at, find = 0, TAG.search
        while m := find(html, at):
            if m.start() > at:
                self.text(html[at:m.start()])
            at = m.end()
            name = m.group(2) or m.group(5)
            if name is None:
                continue
            name = name.lower()
            if m.group(1) or m.group(4):
                self.close(name)
            elif m.group(2) is None and at == len(html) and html[-1:] != ">":
                break  # the page ends inside a tag
            else:
                self.open(name, m.group(3) or "")
                if name in RAW and not self.at_void(name):
                    end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                    stop = end.start() if end else len(html)
                    at = stop
                    if not end:
                        self.cut(len(self.stack) - 1)
        if at < len(html):
            self.text(html[at:])

    def at_void(self, name: str) -> bool:
        return name in VOID

    def text(self, raw: str) -> None:
        node = self.stack[-1]
        if not self.dropped[node]:
            self.pieces.append((node, unescape(raw) if "&" in raw else raw))

    def cut(self, place: int) -> None:
        """Close the elements from this place in the stack on."""
        while len(self.stack) > place:
            name = self.names[self.stack.pop()]
            self.places[name].pop()
            if name in SCOPES:
                self.scopes.pop()

    def open(self, name: str, attributes: str) -> None:
        names, stack = self.names, self.stack
        while True:  # elements that this one closes, up to the innermost scope
            place = max((self.places[c][-1] for c in CLOSES.get(name, ()) if self.places.get(c)), default=0)
            if not place or place < self.scopes[-1]:
                break
            self.cut(place)
        parent = stack[-1]
        kind = _is_part(name, attributes, self.in_landmark[parent])
        names.append(name)
        self.parents.append(parent)
        self.in_landmark.append(self.in_landmark[parent] or name in LANDMARKS)
        self.named.append(kind == NAMED)
        self.dropped.append(self.dropped[parent] or kind == GONE)
        if name not in VOID and not attributes.endswith("/") or name not in VOID and name in INLINE | RAW:
            self.places.setdefault(name, []).append(len(stack))
            if name in SCOPES:
                self.scopes.append(len(stack))
            stack.append(len(names) - 1)
        elif name in VOID:
            self.pieces.append((len(names) - 1, " " if name == "br" else ""))

    def close(self, name: str) -> None:
        if self.places.get(name):
            self.cut(self.places[name][-1])

    def judge_named(self) -> None:
        """Subtrees that a compound class names go, but for those with most of the page's text outside links."""
        if not any(self.named):
            return
        plain = [0] * len(self.names)
        in_link = [False] * len(self.names)
        for i in range(1, len(self.names)):
            in_link[i] = self.names[i] == "a" or in_link[self.parents[i]]
        for i, text in self.pieces:
            if not in_link[i]:
                plain[i] += len("".join(text.split()))
        for i in range(len(self.names) - 1, 0, -1):
            plain[self.parents[i]] += plain[i]
        for i in range(1, len(self.names)):
            self.dropped[i] = self.dropped[i] or self.dropped[self.parents[i]] or self.named[i] and 2 * plain[i] <= plain[0]
        self.pieces = [(i, text) for i, text in self.pieces if not self.dropped[i] or self.names[i] in VOID]

    def content(self) -> list[bool]:
        """For each node whether it belongs to the article."""
        self.judge_named()
        n, names, parents = len(self.names), self.names, self.parents
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = names[i] == "a" or in_link[parents[i]]
        for i, text in self.pieces:
            size = len("".join(text.split()))
            chars[i] += size
            if in_link[i]:
                links[i] += size
        for i in range(n - 1, 0, -1):
            if not self.dropped[i]:
                p = parents[i]
                chars[p] += chars[i]
                links[p] += links[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + (names[i] == "a")
        body = next((i for i in range(n) if names[i] == "body"), 0)
        all_chars, all_links = max(chars[body], 1), links[body]
        density = [0.0] * n
        for i in range(n):
            if chars[i] and not self.dropped[i]:
                c, t, lc, lt = chars[i], max(tags[i], 1), links[i], max(link_tags[i], 1)
                # the base grows with the share of link text, which lowers the density
                base = math.log(c * lc / max(c - lc, 1) + all_links * c / all_chars + math.e)
                density[i] = c / t * max(math.log(c * t / (max(lc, 1) * lt)) / math.log(base) if base > 1.0001 else math.log(c * t / (max(lc, 1) * lt) + 1), 0.0)
        sums = [0.0] * n
        for i in range(1, n):
            sums[parents[i]] += density[i]
        best = list(range(n))  # the node with the largest sum in each subtree, the outermost of equals
        for i in range(n - 1, 0, -1):
            p = parents[i]
            if sums[best[i]] > sums[best[p]] or best[p] != p and sums[best[i]] >= sums[best[p]]:
                best[p] = best[i]
        heart = best[body] if sums[best[body]] > 0 else body
        threshold, i = density[heart], heart
        while i > 0:
            threshold = min(threshold, density[i])
            if names[i] in LANDMARKS or i == body:  # the page itself may say where the article begins and ends
                break
            i = parents[i]
        content = [False] * n
        for i in range(n):
            if not self.dropped[i] and density[i] >= threshold and chars[i]:
                content[i if names[i] in LANDMARKS or sums[best[i]] <= 0 else best[i]] = True
        for i in range(1, n):
            content[i] = (content[i] or content[parents[i]]) and not self.dropped[i]
        return content

    def blocks(self) -> list[str]:
        """The article's blocks: text between the edges of block elements, white space as one blank."""
        content, names, parents = self.content(), self.names, self.parents
        owner = [0] * len(names)  # the block element around each node
        for i in range(1, len(names)):
            owner[i] = owner[parents[i]] if names[i] in INLINE else i
        out, held, at = [], [], None
        last = 0
        for i, text in self.pieces:
            edge = owner[i] != at or any(names[k] not in INLINE for k in range(last + 1, i + 1))
            if edge and held:
                out.append("".join(held))
                held = []
            at, last = owner[i], max(last, i)
            if content[i]:
                held.append(text)
        out.append("".join(held))
        return [b for b in (" ".join(b.split()) for b in out) if b]


def main_text(html: str | None) -> str:
    return "\n".join(Page(html).blocks()) if html else ""


def _extract(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            text = [main_text(x.as_py()) for x in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], schema=schema)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of `pages`: page_id, url, text, n_chars.

    Blocks are joined by line feeds in page order, white space inside a block is one blank, character
    references are decoded. Null, empty and textless pages give an empty text. Cut-off pages are read
    as far as they go. Repeated rows repeat; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.transform(in_arrow, _extract, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
