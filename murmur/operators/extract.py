"""Extraction from raw payloads: threaded comments (C7/H1), flat comments (C8), JSON contents (C9),
payload normalisation (C10), page metadata (C3), cards/anchors (C4), Atom feeds (C5), search JSON
(C6), URL parts (C13), any-depth JSON search (C17), JSON paths (C18) and HTML articles (C2).

Everything but C2 and C17 is native: JSON through VARIANT (`try_parse_json` + `try_variant_get`), XML through
`from_xml`, HTML head tags and anchors through regular expressions. C2 needs an HTML tokenizer and
C17 a walk without depth bound; both run over the columns and rows they need, on the scan's partitions.
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions import html as H
from murmur.functions.json import name_or_text, payload, vget, vstr
from murmur.functions.text import first_nonblank
from murmur.functions.times import epoch_to_ntz, parse_publish_time
from murmur.functions.urls import absolute, first_segment, video_id
from murmur.session import bound_batches

CONTENT_OUT = ["source_id", "source", "keyword", "url", "content_id", "title", "author", "media", "content",
               "published_at", "raw_id"]


def py_or(*cols: Column | str) -> Column:
    """Python `a or b or ''` over strings."""
    return F.coalesce(first_nonblank(*cols), F.lit(""))


def epoch_iso(v: Column) -> Column:
    """Epoch seconds -> ISO text 'yyyy-MM-ddTHH:mm:ss' in UTC; empty or zero -> ''."""
    secs = v.cast("double")
    ntz = epoch_to_ntz(secs)
    return F.when(F.coalesce(secs, F.lit(0.0)) != 0, F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.lit(""))


# ---------------------------------------------------------------- comments

def flatten_comment_threads(raw: DataFrame) -> DataFrame:
    """C7 + H1: a threaded payload (parent with `child[]`) -> one row per comment that has an id.

    `concat(array(parent), child)` + `posexplode` keeps document order; a parent without an id is
    skipped while its children are still emitted. Author may be an object {name} or a string.
    """
    v = payload("raw")
    kids = F.coalesce(vget(v, "$.child", "array<variant>"), F.array().cast("array<variant>"))
    items = raw.select(
        "source", "keyword", F.coalesce("content_id", F.lit("")).alias("content_id"),
        F.coalesce("content_url", F.lit("")).alias("content_url"),
        F.coalesce("parent_id", F.lit("")).alias("raw_parent_id"), F.col("ingest_seq").alias("raw_id"),
        F.posexplode(F.concat(F.array(v), kids)).alias("item_pos", "it"))
    it = F.col("it")
    return items.select(
        "source", "keyword", "content_id", "content_url", "raw_parent_id", "raw_id",
        vstr(it, "$.id").alias("source_id"),
        name_or_text(vget(it, "$.author", "variant")).alias("author"),
        vstr(it, "$.content").alias("content"),
        F.nullif(vstr(it, "$.prokontra"), F.lit("")).alias("prokontra"),
        vstr(it, "$.create_date").alias("published_at"),
    ).where(F.col("source_id") != "")


def comment_ids(v: Column) -> dict[str, Column]:
    """Per comment parser the ids a payload holds, as an array (a payload without any is a reject)."""
    kids = F.coalesce(vget(v, "$.child", "array<variant>"), F.array().cast("array<variant>"))
    return {"thread_json": F.transform(F.concat(F.array(v), kids), lambda it: vstr(it, "$.id")),
            "video_comment": F.array(vstr(v, "$.commentId")), "forum_comment": F.array(vstr(v, "$.id"))}


def flat_comments(raw: DataFrame, source: str) -> DataFrame:
    """One flat comment payload per row (video: commentId/commentText, forum: id/body/created_utc)."""
    v = payload("raw")
    if source == "youtube":
        sid, body = vstr(v, "$.commentId"), vstr(v, "$.commentText")
        published = py_or(vget(v, "$.commentedTime"), vget(v, "$.published"), vget(v, "$.publishedDate"))
    else:
        sid, body = vstr(v, "$.id"), vstr(v, "$.body")
        published = epoch_iso(vget(v, "$.created_utc", "double"))
    return raw.select(
        "source", "keyword", F.coalesce("content_id", F.lit("")).alias("content_id"),
        F.coalesce("content_url", F.lit("")).alias("content_url"),
        F.coalesce("parent_id", F.lit("")).alias("raw_parent_id"), F.col("ingest_seq").alias("raw_id"),
        sid.alias("source_id"), vstr(v, "$.author").alias("author"), body.alias("content"),
        F.lit(None).cast("string").alias("prokontra"), published.alias("published_at"),
    ).where(F.col("source_id") != "")


# ---------------------------------------------------------------- contents

def json_contents(raw: DataFrame, source: str) -> DataFrame:
    """Video / forum contents from a JSON payload, envelope fields first, payload as fallback."""
    v = payload("raw")
    if source == "youtube":
        sid = py_or("content_id", "url")
        title = py_or("title", vget(v, "$.title"))
        author = vstr(v, "$.uploader")
        media = py_or("media", vget(v, "$.uploader"))
        body = vstr(v, "$.description")
        published = py_or("published_at", vget(v, "$.uploadDate"))
    else:
        sid = py_or("content_id", vget(v, "$.id"), "url")
        title = py_or("title", vget(v, "$.title"))
        author = vstr(v, "$.author")
        media = F.coalesce("media", F.lit(""))
        body = vstr(v, "$.selftext")
        published = py_or("published_at", epoch_iso(vget(v, "$.created_utc", "double")))
    return raw.select(
        sid.alias("source_id"), "source", "keyword", F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("content_id", F.lit("")).alias("content_id"), title.alias("title"), author.alias("author"),
        media.alias("media"), body.alias("content"), published.alias("published_at"),
        F.col("ingest_seq").alias("raw_id"))


# Per-source element selectors of the news article layouts (class names as the sites
# use them; by_exact_class = the whole class attribute must match, by_class = any listed token).
ARTICLE_LAYOUT = {
    "detik": {"author": H.by_exact_class("div", "detail__author"), "body": H.by_class("detail__body-text")},
    "cnn": {"author_meta": "author", "body": H.by_class("detail-text", "content-detail", "detail__body-text")},
    "liputan6": {"title_meta": "og:title", "author_meta": "author",
                 "body": H.by_class("article-content-body", "read-page--content")},
    "merdeka": {"title_meta": "og:title", "author_meta": "author",
                "body": H.by_class("article-body-content", "content-detail")},
}

#: For a registered source without a layout of its own: the article or main element, else the body.
DEFAULT_LAYOUT = {"title_meta": "og:title", "author_meta": "author", "body": H.by_tag("article"), "body_else": H.by_tag("body")}

ARTICLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONTENT_OUT[:-1]]
                              + [T.StructField("raw_id", T.LongType())])


#: Pages parsed between two outputs of the Python stage.
PAGES = 64


def _articles_batch(batches):
    for pdf in batches:
        for k in range(0, len(pdf), PAGES):
            yield _articles(pdf.iloc[k:k + PAGES])
    pa.default_memory_pool().release_unused()  # the worker waits for its next task without it


def _articles(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for r in pdf.itertuples(index=False):
        layout = ARTICLE_LAYOUT.get(r.source, DEFAULT_LAYOUT)
        sel = {k: layout[k] for k in ("body", "author", "body_else") if k in layout}
        texts, metas = H.scoped_texts_and_metas(r.raw, sel)
        body = texts["body"] or texts.get("body_else", "")
        title = metas.get(("property", layout.get("title_meta"))) or r.title or ""
        author = texts["author"] if "author" in layout else metas.get(("name", layout["author_meta"])) or ""
        out.append((r.content_id or r.url or "", r.source, r.keyword, r.url or "", r.content_id or "", title,
                    author, r.media or "", body, r.published_at or "", r.ingest_seq))
    return pd.DataFrame(out, columns=CONTENT_OUT)


def extract_articles(raw: DataFrame) -> DataFrame:
    """Article HTML of the given rows -> contents rows (title, author, body by the source's layout,
    or by the default one); empty payloads are skipped (the cleaner lists them as rejects).

    The filter runs before the Python stage; only the needed columns cross into Arrow batches of bounded
    bytes, on the partitions of the scan, and results leave every few pages: a worker holds one small
    batch, however many rows its partition has.
    """
    bound_batches(raw.sparkSession)
    cols = ["ingest_seq", "source", "keyword", "url", "content_id", "title", "media", "published_at", "raw"]
    return raw.where(F.coalesce(F.col("raw"), F.lit("")) != "").select(*cols).mapInPandas(_articles_batch, ARTICLE_SCHEMA)


def normalise_payload(raw: DataFrame) -> DataFrame:
    """Payload validity and top-level keys (bad or non-object JSON reads as an empty object)."""
    keys = F.array_join(F.sort_array(F.json_object_keys("raw")), ",")
    ok = payload("raw").isNotNull() & F.coalesce(F.schema_of_variant(payload("raw")).startswith("OBJECT"), F.lit(False))
    return raw.select("ingest_seq", ok.alias("is_object"), F.when(ok, keys).otherwise(F.lit("")).alias("top_keys"))


# ---------------------------------------------------------------- pages

def page_meta(pages: DataFrame) -> DataFrame:
    """Head metadata, each with ordered fallbacks: title (og:title, <title>), author (author meta,
    article:author), publish time (article:published_time, date), article id (dtk:articleid), language."""
    of = lambda attr, name: H.meta_of("metas", attr, name)
    read = pages.select("ingest_seq", "raw", H.meta_fields(F.col("raw"), "property", "name").alias("metas"))
    read = read.select(
        "ingest_seq",
        py_or(of("property", "og:title"), H.title_text(F.col("raw"))).alias("title"),
        py_or(of("name", "author"), of("property", "article:author")).alias("author"),
        py_or(of("property", "article:published_time"), of("name", "date")).alias("published_at"),
        of("name", "dtk:articleid").alias("article_id"),
        H.html_lang(F.col("raw")).alias("lang"))
    return read.select("ingest_seq", "title", "author", "published_at", parse_publish_time(F.col("published_at")).alias("published_ts"), "article_id", "lang")


#: Article id in a card's link: the last number of its path (fixed value).
CARD_ID = r"[/-]([0-9]+)(?:-mvk)?(?:\.html)?(?:[/?#][^/]*)?$"


def extract_cards(pages: DataFrame, link: str = "/read/", base_col: str = "url", id_pattern: str = CARD_ID) -> DataFrame:
    """C4: cards of result pages: every anchor whose link holds `link` and an id, in document order, the
    first of each id per page, with absolute url, title (an inner h2/h3, else the anchor's text; cards
    without one are left out), category (first path segment) and date (an inner `time` or `.timestamp`,
    else the first one after the anchor and before the next).
    """
    base = F.regexp_extract(base_col, r"^(https?://[^/]+)", 1)
    parts = F.regexp_extract_all("raw", F.lit(H.ANCHOR_AND_AFTER), 0)
    a = pages.select("ingest_seq", base.alias("base"), F.posexplode(parts).alias("i", "a"))
    anchor, inner = F.regexp_extract("a", H.ANCHOR, 1), F.regexp_extract("a", H.ANCHOR, 2)
    href = H.attribute(anchor, "href")
    heading = H.text_of(F.regexp_extract(inner, r"(?is)<h[23]\b[^>]*>(.*?)</h[23]>", 1))
    a = a.select("ingest_seq", "i", "base", href.alias("href"), F.regexp_extract(href, id_pattern, 1).alias("content_id"),
                 py_or(heading, H.text_of(inner)).alias("title"), H.text_of(F.regexp_extract("a", H.TIME, 1)).alias("date"))
    a = a.where(F.col("href").contains(link) & (F.col("content_id") != "") & (F.col("title") != ""))
    first = a.groupBy("ingest_seq", "content_id").agg(F.min(F.struct("i", "base", "href", "title", "date")).alias("c")).select("ingest_seq", "content_id", "c.*")
    return first.select("ingest_seq", F.col("i").cast("long").alias("pos"), "content_id", absolute("href", "base").alias("url"), "title", first_segment("href").alias("category"),
                        "date", parse_publish_time("date").alias("published_ts"))


def url_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Host, first path segment, numeric article id, query params `page` and `ref`."""
    u = F.col(url_col)
    return df.select(
        "ingest_seq", u.alias("url"),
        F.try_parse_url(u, F.lit("HOST")).alias("host"),
        F.regexp_extract(u, r"^[a-z]+://[^/]+/([^/?#]*)", 1).alias("segment"),
        F.nullif(F.regexp_extract(u, r"/([0-9]+)(?:[/?#.]|$)", 1), F.lit("")).alias("article_id"),
        F.try_parse_url(u, F.lit("QUERY"), F.lit("page")).alias("page_param"),
        F.try_parse_url(u, F.lit("QUERY"), F.lit("ref")).alias("ref_param"))


# ---------------------------------------------------------------- feeds and search JSON

FEED_SCHEMA = ("entry ARRAY<STRUCT<id: STRING, published: STRING, link: STRUCT<_href: STRING>, title: STRING, "
               "author: STRUCT<name: STRING>, category: STRUCT<_term: STRING>>>")


def extract_feed_entries(feeds: DataFrame) -> DataFrame:
    """Atom feed text -> posts: only `t3_` ids, prefix cut, '/u/' cut from the author (anchored,
    not the character-set strip), media 'r/<category>'."""
    e = feeds.select("keyword", F.explode(F.from_xml("raw", FEED_SCHEMA)["entry"]).alias("e"))
    return e.where(F.col("e.id").startswith("t3_")).select(
        "keyword",
        F.regexp_replace("e.id", "^t3_", "").alias("content_id"),
        F.coalesce(F.col("e.link._href"), F.lit("")).alias("url"),
        F.coalesce(F.col("e.title"), F.lit("")).alias("title"),
        F.regexp_replace(F.coalesce(F.col("e.author.name"), F.lit("")), r"^/u/", "").alias("author"),
        F.when(F.coalesce(F.col("e.category._term"), F.lit("")) != "",
               F.concat(F.lit("r/"), F.col("e.category._term"))).otherwise(F.lit("")).alias("media"),
        F.coalesce(F.col("e.published"), F.lit("")).alias("published_at"))


SEARCH_SCHEMA = ("data ARRAY<STRUCT<id: STRING, title: STRING, url: STRING>>, "
                 "items ARRAY<STRUCT<type: STRING, url: STRING, title: STRING, uploaderName: STRING>>")


def extract_json_items(pages: DataFrame) -> DataFrame:
    """Search-result JSON -> candidates: news `data[]`, video `items[]` of type 'stream' with the
    video id taken from the `v=` query parameter."""
    p = pages.select("keyword", "source", "page", F.from_json("raw", SEARCH_SCHEMA).alias("j"))
    news = p.select("keyword", "source", "page", F.posexplode("j.data").alias("pos0", "it")).select(
        "keyword", "source", "page", (F.col("pos0") + 1).alias("pos"), F.col("it.id").alias("item_id"),
        F.col("it.url").alias("url"), F.lit(None).cast("string").alias("video_id"))
    vids = (p.select("keyword", "source", "page", F.posexplode("j.items").alias("pos0", "it"))
            .where(F.col("it.type") == "stream")
            .select("keyword", "source", "page", (F.col("pos0") + 1).alias("pos"),
                    F.lit(None).cast("string").alias("item_id"),
                    F.col("it.url").alias("url"),
                    video_id(absolute("it.url", F.lit("https://www.youtube.com"))).alias("video_id")))
    return news.unionByName(vids)


# ---------------------------------------------------------------- JSON search

def _empty(value) -> bool:
    return value is None or value == "" or value == [] or value == {}


def _hits(data, keys: tuple[str, ...]):
    """(places, names, value) of every non-empty value found under the keys, each at any depth below
    the one before it; members come in key order, items in index order."""
    stack, seen = [(data, 0, (), ())], set()
    while stack:
        node, k, places, names = stack.pop()
        members = sorted(node.items()) if isinstance(node, dict) else list(enumerate(node)) if isinstance(node, list) else ()
        for place, (name, value) in enumerate(members):
            at, path = (*places, place), (*names, str(name))
            if isinstance(node, dict) and name == keys[k]:
                if k == len(keys) - 1:
                    if not _empty(value) and at not in seen:
                        seen.add(at)
                        yield at, path, value
                elif isinstance(value, (dict, list)):
                    stack.append((value, k + 1, at, path))
            if isinstance(value, (dict, list)):
                stack.append((value, k, at, path))


def _deep_find(paths: tuple[tuple[str, ...], ...]):
    schema = pa.schema([("_id", pa.int64()), ("depth", pa.int32()), ("path", pa.string()), ("value", pa.string()), ("first", pa.bool_())])

    def text(value):
        return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False)

    def run(batches):
        for batch in batches:
            out = []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    data = json.loads(raw or "null")
                except (ValueError, RecursionError):
                    continue  # no JSON (or nested beyond any parser): nothing to find
                for keys in paths:
                    found = sorted((len(at), at, path, value) for at, path, value in ((a, p, text(v)) for a, p, v in _hits(data, keys)))
                    if found:
                        out += [(i, n, "/" + "/".join(path), value, k == 0) for k, (n, _, path, value) in enumerate(found)]
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def json_deep_find(df: DataFrame, *paths: str, id_col: str = "ingest_seq") -> DataFrame:
    """C17: the non-empty values found anywhere in a JSON payload under a key path, at any depth.

    A path is a key or several joined by dots, each found at any depth below the one before it. With
    several paths the first one that has a hit in a row counts for it. Per hit: depth, path, value
    (text, or compact JSON), and whether it is the row's first: the shallowest, ties in key and
    index order. JSON has no depth bound that built-in functions could unroll, so each payload is
    walked in the task, without recursion.
    """
    keys = tuple(tuple(p.split(".")) for p in paths)
    found = df.select(F.col(id_col).cast("long"), "raw").mapInArrow(_deep_find(keys), "_id long, depth int, path string, value string, first boolean")
    return found.withColumnRenamed("_id", id_col)
