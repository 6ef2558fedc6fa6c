"""Domain views over the driver's tables (FIXTURES.md section 3), written as DataFrame plans.

The test data are TPC-H-ish tables plus `events`, `documents`, `conversations`, `pages` and `labels`.
These functions map them onto the opinion domain so every operator runs on rows that grow with the
input. The DuckDB oracle inlines the same definitions as SQL (``murmur.plans.oracle``).

All "now"-relative logic is pinned to NOW (2024-01-30); nothing calls the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.functions.times import epoch_to_ntz
from murmur.sources.tables import read_table

def opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_opinions: one row per event, mapped to an opinion (comment or post) with a sentiment label."""
    return opinions_from_events(read_table(spark, sf_dir, "events"))


def opinions_from_events(events: DataFrame) -> DataFrame:
    """The events -> opinions mapping (batch or streaming input)."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    u4 = (F.col("user_id") % 4).cast("int")
    return ev.select(
        F.col("event_id").cast("string").alias("source_id"),
        F.when(u4 == 0, "reddit").when(u4 == 1, "youtube").when(u4 == 2, "detik").otherwise("cnn").alias("source"),
        F.col("event_type").alias("keyword"),
        F.when((F.col("user_id") % 4 == 0) & (F.col("event_id") % 5 == 0), "post").otherwise("comment").alias("kind"),
        F.col("user_id").cast("string").alias("content_id"),
        F.col("user_id").cast("string").alias("author"),
        F.col("props").alias("raw"),
        F.when(F.col("value") < 10, "neutral").when(F.col("value") < 40, "negative")
        .otherwise("positive").alias("sentiment"),
        F.when(F.col("event_id") % 10 == 0, F.lit(False)).otherwise(F.lit(True)).alias("ai_processed"),
        ((F.col("event_id") % 100) / F.lit(100.0)).alias("confidence"),
        F.to_date("ts").alias("day"),
        F.col("ts").alias("published_ts"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_candidates: ten search-result lists (keyword x source), 20 per page, newest block first.

    `pos` is the rank inside a list ordered by (block desc, event_id). Instead of one window over a
    whole list (a single task per list), positions are built from bounded windows: row numbers
    inside each 500-event block, plus the size of all preceding blocks, itself a two-level prefix
    sum (blocks inside a superblock of 1,000 blocks, then superblocks) over per-block counts.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    base = ev.select(
        F.col("event_type").alias("keyword"),
        F.when(F.col("event_id") % 2 == 0, "cnn").otherwise("liputan6").alias("source"),
        F.col("user_id").cast("string").alias("content_id"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("ts")).alias("published_ts"),
        F.floor(F.col("event_id") / F.lit(500.0)).alias("block"),
        F.col("event_id"),
    )
    lst = ["keyword", "source"]
    sizes = (base.groupBy(*lst, "block").agg(F.count(F.lit(1)).alias("block_n"))
             .withColumn("sb", F.floor(F.col("block") / 1000)))
    # blocks before this one inside its superblock (newest block first)
    inner = sizes.withColumn("in_sb", F.sum("block_n").over(
        Window.partitionBy(*lst, "sb").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, 0))
        - F.col("block_n"))
    # all rows of the superblocks before this one
    sb = sizes.groupBy(*lst, "sb").agg(F.sum("block_n").alias("sb_n"))
    sb = sb.withColumn("before_sb", F.sum("sb_n").over(
        Window.partitionBy(*lst).orderBy(F.col("sb").desc()).rowsBetween(Window.unboundedPreceding, 0)) - F.col("sb_n"))
    offsets = inner.join(sb.select(*lst, "sb", "before_sb"), lst + ["sb"]).select(
        *lst, "block", (F.col("before_sb") + F.col("in_sb")).alias("offset"))
    w_in = Window.partitionBy(*lst, "block").orderBy("event_id")
    ranked = base.withColumn("rn", F.row_number().over(w_in))
    out = ranked.join(offsets, lst + ["block"]).select(
        *lst, "content_id", "published_ts", (F.col("offset") + F.col("rn")).cast("long").alias("pos"))
    return out.withColumn("page", (F.floor((F.col("pos") - 1) / F.lit(20.0)).cast("long") + 1))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_contents: one article per document; every 7th content_id is empty, so the url is the key."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return d.select(
        F.col("doc_id").cast("string").alias("source_id"),
        "source",
        F.col("lang").alias("keyword"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(F.col("doc_id").cast("string")).alias("content_id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
        F.col("doc_id").alias("ingest_seq"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_comments: one comment per conversation turn; turn 0 is the thread's parent."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return c.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("source_id"),
        F.col("conv_id").cast("string").alias("content_id"),
        "turn",
        F.col("role").alias("author"),
        F.col("text").alias("content"),
        F.when((F.col("conv_id") % 2).cast("int") == 0, "detik").otherwise("cnn").alias("source"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_labelled: documents joined to their labels, mapped to a sentiment."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id").select(
        "doc_id", "source", F.col("lang").alias("keyword"), F.col("text").alias("content"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("neutral").alias("sentiment"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_raw_pages: raw HTML pages as raw-zone content documents."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.select(
        F.col("page_id").alias("ingest_seq"),
        F.lit("content").alias("type"),
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("source"),
        F.regexp_extract("url", r"/([a-z][a-z])/([0-9]+)", 1).alias("keyword"),
        "url",
        F.regexp_extract("url", r"/([a-z][a-z])/([0-9]+)", 2).alias("content_id"),
        F.col("html").alias("raw"),
    )


def url_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_cache: md5(url) keys of already-fetched pages with an expiry day (odd ids expired at NOW)."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.where(F.col("page_id") % 3 == 0).select(
        F.md5("url").alias("cache_key"),
        F.when(F.col("page_id") % 2 == 0, F.to_date(F.lit("2024-02-15")))
        .otherwise(F.to_date(F.lit("2024-01-10"))).alias("expires_on"),
    )


# ---------------------------------------------------------------- raw zone (schema R)

TURNS = 1 << 20   # raw ids set aside for the turns of one conversation
CONTENT_SOURCES = ("detik", "cnn", "liputan6", "merdeka", "youtube", "reddit", "kompas")
COMMENT_SOURCES = ("detik", "cnn", "youtube", "reddit", "kompas")
NEWS_SOURCES = ("detik", "cnn", "liputan6", "merdeka")


def _pick(values: tuple[str, ...], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def _article_html(doc_id: Column, lang: Column, text: Column) -> Column:
    """A news page around a document body: head metadata plus one body block per news layout."""
    i = doc_id.cast("string")
    return F.concat(
        F.lit('<!DOCTYPE html><html lang="'), lang, F.lit('"><head><meta charset="utf-8">'),
        F.lit('<meta name="author" content="Desk '), (doc_id % 9).cast("string"), F.lit('">'),
        F.lit('<meta property="og:title" content="Story '), i, F.lit('">'),
        F.lit("<title>Story "), i, F.lit(" - News</title>"),
        F.lit('<script>var s="</div>";</script></head><body><nav><a href="/x">x</a></nav>'),
        F.lit('<div class="detail__author">Reporter '), (doc_id % 5).cast("string"), F.lit("</div>"),
        F.lit('<div class="detail__body-text detail-text article-content-body article-body-content">'),
        F.lit("<p>"), F.regexp_replace(text, "\n", "</p><p>"), F.lit("</p></div>"),
        F.lit('<div class="ad">Advertisement</div></body></html>'))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_raw_documents: the raw zone (schema R) with contents and comments of six sources plus one
    unknown source ('kompas').

    contents: one per document; news sources carry article HTML, video/forum carry a JSON payload;
      every 13th has an empty payload, every 11th an empty content_id (url is the key).
    comments: news sources carry one threaded payload per conversation (turn 0 is the parent, later
      turns are `child`), video/forum carry one flat payload per turn.
    ingest_seq: contents 2*doc_id, comments 2*(2^20*conv_id + turn) + 1 (the parent's turn for threads).
    parent_id: the raw id of the document with the conversation's number.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    src = _pick(CONTENT_SOURCES, F.col("doc_id"))
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 29).cast("int"))
    epoch = F.datediff(day, F.to_date(F.lit("1970-01-01"))).cast("long") * 86400 + (F.col("doc_id") % 86400)
    payload = F.to_json(F.struct(
        F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("Post "), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit("channel"), (F.col("doc_id") % 17).cast("string")).alias("uploader"),
        F.concat(F.lit("user"), (F.col("doc_id") % 23).cast("string")).alias("author"),
        F.col("text").alias("description"), F.col("text").alias("selftext"),
        F.date_format(day, "yyyy-MM-dd").alias("uploadDate"), epoch.alias("created_utc")))
    raw = (F.when(F.col("doc_id") % 13 == 0, F.lit(""))
           .when(src.isin("youtube", "reddit"), payload)
           .otherwise(_article_html(F.col("doc_id"), F.col("lang"), F.col("text"))))
    contents_r = d.select(
        (F.col("doc_id") * 2).alias("ingest_seq"), F.lit("content").alias("type"), src.alias("source"),
        F.col("lang").alias("keyword"),
        F.concat(F.lit("https://"), src, F.lit(".example/read/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 11 == 0, F.lit("")).otherwise(F.col("doc_id").cast("string")).alias("content_id"),
        F.when(src.isin("youtube", "reddit"), F.lit("")).otherwise(
            F.concat(F.lit("Card "), F.col("doc_id").cast("string"))).alias("title"),
        F.lit("").alias("media"), F.lit("").alias("desc"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("published_at"),
        F.lit(None).cast("string").alias("content_url"), F.lit(None).cast("string").alias("parent_id"),
        raw.alias("raw"))

    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    csrc = _pick(COMMENT_SOURCES, F.col("conv_id"))
    cid = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    csecs = F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60
    cts = epoch_to_ntz(csecs)
    item = F.struct(
        cid.alias("id"), F.col("turn"), F.col("role"),
        F.col("text").alias("content"),
        F.when(F.col("turn") % 3 == 0, F.lit("pro")).alias("prokontra"),
        F.date_format(cts, "yyyy-MM-dd HH:mm:ss").alias("create_date"))

    def author(it: Column) -> Column:
        # an object {name} on even turns and a plain string on odd ones (both shapes occur upstream)
        return F.when(it["turn"] % 2 == 0, F.parse_json(F.to_json(F.struct(it["role"].alias("name"))))) \
            .otherwise(F.parse_json(F.concat(F.lit('"'), it["role"], F.lit('"'))))

    flat = c.where(~csrc.isin(*NEWS_SOURCES)).select(
        (2 * (TURNS * F.col("conv_id") + F.col("turn")) + 1).alias("ingest_seq"), csrc.alias("source"),
        F.col("conv_id"),
        F.to_json(F.struct(
            cid.alias("id"), cid.alias("commentId"), F.col("role").alias("author"),
            F.col("text").alias("body"), F.col("text").alias("commentText"),
            csecs.alias("created_utc"),
            F.date_format(cts, "yyyy-MM-dd HH:mm:ss").alias("commentedTime"))).alias("raw"))
    # A thread is one API item (a comment and its replies), so its size is bounded by the source.
    threads = (c.where(csrc.isin(*NEWS_SOURCES))
               .groupBy("conv_id")
               .agg(F.min_by(item, F.col("turn")).alias("parent"),
                    F.sort_array(F.collect_list(F.when(F.col("turn") > 0, item))).alias("kids")))
    threads = threads.select(
        (2 * (TURNS * F.col("conv_id")) + 1).alias("ingest_seq"), _pick(COMMENT_SOURCES, F.col("conv_id")).alias("source"),
        "conv_id",
        F.to_json(F.struct(
            F.col("parent.id").alias("id"), author(F.col("parent")).alias("author"),
            F.col("parent.content").alias("content"), F.col("parent.prokontra").alias("prokontra"),
            F.col("parent.create_date").alias("create_date"),
            F.transform("kids", lambda k: F.struct(
                k["id"].alias("id"), author(k).alias("author"), k["content"].alias("content"),
                k["create_date"].alias("create_date"))).alias("child"))).alias("raw"))
    comments_r = flat.unionByName(threads).select(
        "ingest_seq", F.lit("comment").alias("type"), "source", F.lit("thread").alias("keyword"),
        F.lit(None).cast("string").alias("url"), F.col("conv_id").cast("string").alias("content_id"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("media"),
        F.lit(None).cast("string").alias("desc"), F.lit(None).cast("string").alias("published_at"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/read/c"), F.col("conv_id").cast("string"))
        .alias("content_url"),
        (2 * F.col("conv_id")).cast("string").alias("parent_id"), "raw")
    return contents_r.unionByName(comments_r)


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_feed: Atom feed documents from events, one per (event_type, block of 100 ids) — a feed page
    holds at most 100 entries upstream, so each group is bounded. Every 10th id is a `t5_` entry."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    pref = F.when(F.col("event_id") % 10 == 0, F.lit("t5_")).otherwise(F.lit("t3_"))
    entry = F.concat(
        F.lit("<entry><id>"), pref, F.col("event_id").cast("string"), F.lit("</id><published>"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00</published>"),
        F.lit('<link href="https://forum.example/r/'), F.col("event_type"), F.lit("/comments/"),
        F.col("event_id").cast("string"), F.lit('"/><title>Post '), F.col("event_id").cast("string"),
        F.lit("</title><author><name>/u/user"), F.col("user_id").cast("string"),
        F.lit('</name></author><category term="'), F.col("event_type"), F.lit('"/></entry>'))
    g = (ev.groupBy("event_type", F.floor(F.col("event_id") / 100).alias("blk"))
         .agg(F.sort_array(F.collect_list(F.struct("event_id", entry.alias("x")))).alias("es")))
    return g.select(
        F.col("event_type").alias("keyword"), "blk",
        F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>search</title>'),
                 F.array_join(F.transform("es", lambda e: e["x"]), ""), F.lit("</feed>")).alias("raw"))


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_json_pages: one search-result JSON per candidate page (20 items, bounded): news lists as
    `{"data": [...]}`, the other lists as video search `{"items": [...]}` where every item whose
    id is a multiple of 7 is a channel, not a stream."""
    c = candidates(spark, sf_dir)
    item = F.struct(
        "pos",
        F.when(F.col("source") == "cnn", F.to_json(F.struct(
            F.col("content_id").alias("id"), F.concat(F.lit("Title "), F.col("content_id")).alias("title"),
            F.concat(F.lit("https://cnn.example/read/"), F.col("content_id")).alias("url"))))
        .otherwise(F.to_json(F.struct(
            F.when(F.col("content_id").cast("int") % 7 == 0, F.lit("channel")).otherwise(F.lit("stream")).alias("type"),
            F.concat(F.lit("/watch?v=v"), F.col("content_id")).alias("url"),
            F.concat(F.lit("Video "), F.col("content_id")).alias("title"),
            F.lit("uploader").alias("uploaderName")))).alias("j"))
    g = c.groupBy("keyword", "source", "page").agg(F.sort_array(F.collect_list(item)).alias("its"))
    body = F.concat(F.lit("["), F.array_join(F.transform("its", lambda i: i["j"]), ","), F.lit("]"))
    return g.select("keyword", "source", "page",
                    F.when(F.col("source") == "cnn", F.concat(F.lit('{"data":'), body, F.lit("}")))
                    .otherwise(F.concat(F.lit('{"items":'), body, F.lit("}"))).alias("raw"))


# Indonesian month names used in day-month-year publish dates.
MONTHS_ID = ("Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September",
             "Oktober", "November", "Desember")


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_times: events.ts printed in one of nine publish-time formats by event_id % 9: ISO, with a
    blank, 'd <Indonesian month> yyyy', epoch seconds, ISO with offset +07:00, with Z, to the minute,
    a date alone, epoch milliseconds (all of UTC)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    k = (F.col("event_id") % 9).cast("int")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS_ID]), F.month("ts"))
    epoch = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    iso = lambda c, f="yyyy-MM-dd'T'HH:mm:ss": F.date_format(c, f)
    text = (F.when(k == 0, iso("ts")).when(k == 1, iso("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(k == 2, F.concat_ws(" ", F.dayofmonth("ts").cast("string"), month, F.year("ts").cast("string")))
            .when(k == 3, epoch.cast("string"))
            .when(k == 4, F.concat(iso(F.col("ts") + F.expr("INTERVAL 7 HOURS")), F.lit("+07:00")))
            .when(k == 5, F.concat(iso("ts"), F.lit("Z"))).when(k == 6, iso("ts", "yyyy-MM-dd'T'HH:mm"))
            .when(k == 7, iso("ts", "yyyy-MM-dd")).otherwise((epoch * 1000).cast("string")))
    return ev.select("event_id", "ts", text.alias("published_at"))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_result_pages: per page a search-result page as the sites write them: attributes in any order and
    quoting, nested tags, relative and absolute links, a card without title, a repeated one and a link
    that is no card; head metadata with its fallbacks by page_id."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    i, day = F.col("page_id").cast("string"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    of = lambda k: F.when(F.col("page_id") % k == 0, True).otherwise(False)
    cat = F.concat
    head = cat(F.lit("<!DOCTYPE html><html class=\"x\" lang='id'><head><meta charset=utf-8>"),
               F.when(of(4), F.lit("")).otherwise(cat(F.lit("<meta content='Story &quot;"), i, F.lit("&quot;' property=\"og:title\">"))),
               F.when(of(3), cat(F.lit('<meta property="article:author" content="Writer '), i, F.lit('">'))).otherwise(cat(F.lit('<meta content="Desk '), i, F.lit('" name=author>'))),
               F.when(of(5), cat(F.lit("<meta name='date' content='2024-01-"), day, F.lit("'>")))
               .otherwise(cat(F.lit('<meta property="article:published_time" content="2024-01-'), day, F.lit('T03:00:00+07:00">'))),
               F.lit('<meta name="dtk:articleid" content="'), i, F.lit('" /><title data-x="1">Page '), i, F.lit("</title></head>"))
    body = cat(F.lit("<body><div class=\"card\"><a data-a='1' href=\"/news/read/"), i, F.lit('0/x"><h3 class="t">Title <b>'), i,
               F.lit("0</b></h3> <span class='timestamp small'>30 Januari 2024</span></a></div>"),
               F.lit("<a href='https://s.example/sport/read/"), i, F.lit("1?a=1' class=c>Plain "), i, F.lit('1 &amp; more</a><time datetime="x">2024-01-05 10:00</time>'),
               F.lit("<a href=/biz/read/"), i, F.lit("2> <img src=x> </a>"),
               F.lit('<a href="/news/read/'), i, F.lit('0/x">Again</a><a href="/about">About</a></body></html>'))
    return p.select(F.col("page_id").alias("ingest_seq"), F.lit("https://host.example/search?q=1").alias("url"), cat(head, body).alias("raw"))


def read_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_read_cache: cached article urls of candidates (users that are multiples of 3), even ones still live."""
    u = read_table(spark, sf_dir, "events").select("user_id").where(F.col("user_id") % 3 == 0).distinct()
    sites = F.explode(F.array(F.lit("cnn"), F.lit("liputan6"))).alias("source")
    return u.select("user_id", sites).select(
        F.md5(F.concat(F.lit("https://"), "source", F.lit(".example/read/"), F.col("user_id").cast("string"))).alias("cache_key"),
        F.when(F.col("user_id") % 2 == 0, F.to_date(F.lit("2024-02-15"))).otherwise(F.to_date(F.lit("2024-01-10"))).alias("expires_on"))


def job_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword job messages (JSON text) derived from events: every 50th keyword is blank and the
    next one missing; interval, platforms, news_sources, force and limit vary, some absent."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    e50 = F.col("event_id") % 50
    msg = F.struct(
        F.when(e50 == 0, F.lit("   ")).when(e50 == 1, F.lit(None)).otherwise(F.col("event_type")).alias("keyword"),
        F.element_at(F.array(F.lit("30d"), F.lit("7d"), F.lit("1m"), F.lit("2w"), F.lit(None).cast("string")),
                     (F.col("event_id") % 5).cast("int") + 1).alias("interval"),
        F.element_at(F.array(F.lit("all"), F.lit("news"), F.lit("socmed")), (F.col("user_id") % 3).cast("int") + 1)
        .alias("platforms"),
        F.when(F.col("user_id") % 2 == 0, F.lit("all")).otherwise(F.lit("detik,cnn")).alias("news_sources"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_id") % 7 == 0).alias("force"),
        F.when(F.col("event_id") % 13 == 0, F.lit(0)).when(F.col("event_id") % 4 == 0, F.lit(20))
        .alias("limit"))
    return ev.select(F.col("event_id").alias("job_id"), F.to_json(msg).alias("value"))
