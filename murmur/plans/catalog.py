"""

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole input tables. Serving
outputs carry days as 'yyyy-MM-dd' and times as 'yyyy-MM-dd HH:mm:ss' text (the API's JSON format),
doubles rounded to 6 places, and every computed column has an explicit name shared with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import fixtures as fx
from murmur.functions.text import first_nonblank
from murmur.functions.times import iso_day, iso_ts, parse_publish_time, recency_bucket
from murmur.operators import analytics as an
from murmur.operators import candidates as cd
from murmur.operators import cleaner as cl
from murmur.operators import extract as X
from murmur.operators import jobs as jb
from murmur.operators import sentiment as se
from murmur.operators import warehouse as wh

TODAY = datetime(2024, 1, 30)
SECRET = "murmur-pseudonym-key"   # for the demonstration queries; a deployment passes its own

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(key: str):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        return fn
    return deco


def _fmt_day(df: DataFrame, col: str = "day") -> DataFrame:
    return df.withColumn(col, iso_day(col))


# ============================================================ serving analytics (v_opinions)

@register("keyword_sentiment_daily")
def q_keyword_sentiment_daily(spark, d):
    return _fmt_day(an.keyword_sentiment_daily(fx.opinions(spark, d)))


@register("daily_signal")
def q_daily_signal(spark, d):
    return _fmt_day(an.daily_signal(fx.opinions(spark, d)))


@register("opinions_filter")
def q_opinions_filter(spark, d):
    feed = an.unified_feed(fx.opinions(spark, d), fx.contents(spark, d))
    out = an.filter_feed(feed, keyword="view", sentiment="negative", kind="opinion",
                         window="10/01/2024 - 20/01/2024", today=TODAY)
    return out.select("source_id", "source", "keyword", "kind", "sentiment",
                      iso_ts("published_ts").alias("published_at"))


@register("unprocessed_comments")
def q_unprocessed_comments(spark, d):
    from murmur.operators.sentiment import unprocessed
    op = fx.opinions(spark, d).withColumnRenamed("raw", "content")
    return unprocessed(op).select("source_id", "source", "keyword", "content")


@register("sentiment_headline")
def q_sentiment_headline(spark, d):
    return an.sentiment_headline(fx.opinions(spark, d), window="30d", today=TODAY)


@register("sentiment_distribution")
def q_sentiment_distribution(spark, d):
    return an.sentiment_distribution(fx.opinions(spark, d))


@register("source_counts")
def q_source_counts(spark, d):
    return an.source_counts(fx.opinions(spark, d), fx.contents(spark, d))


@register("top_words_by_sentiment")
def q_top_words_by_sentiment(spark, d):
    return an.top_words_by_sentiment(fx.labelled(spark, d), k=5)


@register("trending_keywords")
def q_trending_keywords(spark, d):
    return an.trending_keywords(fx.opinions(spark, d), days=7, today=TODAY)


@register("compare_keywords")
def q_compare_keywords(spark, d):
    return an.compare_keywords(fx.opinions(spark, d))


@register("comments_per_content")
def q_comments_per_content(spark, d):
    return an.comments_per_content(fx.opinions(spark, d))


@register("opinion_rollup")
def q_opinion_rollup(spark, d):
    return an.opinion_rollup(fx.opinions(spark, d))


def _kept(spark, d):
    """The opinions' daily aggregates, kept half by half; days in the middle are kept again."""
    from murmur.operators import kept as kp
    from murmur.streaming.common import new_location
    op, base = fx.opinions(spark, d), new_location(spark, "tables", "kept")
    middle = date(2024, 1, 15)
    kp.keep(op.where(F.col("day") <= F.lit(middle)), base)
    kp.keep(op.where(F.col("day") >= F.lit(middle)), base)
    return kp.kept(spark, base)


@register("kept_headline")
def q_kept_headline(spark, d):
    from murmur.operators import kept as kp
    return kp.headline(_kept(spark, d), window="30d", today=TODAY)


@register("kept_compare")
def q_kept_compare(spark, d):
    from murmur.operators import kept as kp
    return kp.compare(_kept(spark, d))


@register("kept_serving")
def q_kept_serving(spark, d):
    from murmur.operators import kept as kp
    rows = kp.serving(_kept(spark, d), "keyword", "source", "day", "sentiment", since=date(2024, 1, 8), until=date(2024, 1, 21))
    return _fmt_day(rows.drop("opinions", "contents"))


@register("sentiment_shift_alert")
def q_sentiment_shift_alert(spark, d):
    return _fmt_day(an.sentiment_shift_alert(fx.opinions(spark, d), label="negative", threshold=0.20, min_n=10))


@register("sentiment_gap_change")
def q_sentiment_gap_change(spark, d):
    return an.sentiment_gap_change(fx.opinions(spark, d), period_days=7, today=TODAY)


@register("scaled_volume")
def q_scaled_volume(spark, d):
    return _fmt_day(an.scaled_volume(fx.opinions(spark, d)))


@register("newest_opinions")
def q_newest_opinions(spark, d):
    return an.newest(fx.opinions(spark, d), k=20).select(
        "source_id", "source", "keyword", "sentiment", iso_ts("published_ts").alias("published_at"))


@register("window_filter")
def q_window_filter(spark, d):
    from murmur.functions.times import in_window
    op = fx.opinions(spark, d)
    return op.where(in_window("published_ts", "7d", TODAY)).select(
        "source_id", "keyword", iso_ts("published_ts").alias("published_at"))


@register("recency_bucket")
def q_recency_bucket(spark, d):
    op = fx.opinions(spark, d)
    age = F.datediff(F.lit(TODAY.date()), F.col("day"))
    return op.groupBy("keyword", recency_bucket(age).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


# ============================================================ opinions + contents

def _articles(spark, d):
    """Contents of the opinions' four sources, three of them sharing each content id."""
    doc = F.col("ingest_seq")
    source = F.element_at(F.array(*[F.lit(x) for x in ("reddit", "youtube", "detik", "cnn")]), (doc % 4).cast("int") + 1)
    shared = F.when(doc % 7 == 0, F.lit("")).otherwise(F.floor(doc / 3).cast("string"))
    return fx.contents(spark, d).withColumn("source", source).withColumn("content_id", shared)


@register("feed_with_parent")
def q_feed_with_parent(spark, d):
    return an.feed_with_parent(fx.opinions(spark, d), _articles(spark, d))


@register("contents_with_opinions")
def q_contents_with_opinions(spark, d):
    return an.contents_with_opinions(_articles(spark, d), fx.opinions(spark, d)).select(
        "source_id", "source", "keyword", "content_id", "url")


@register("unified_feed")
def q_unified_feed(spark, d):
    return an.unified_feed(fx.opinions(spark, d), fx.contents(spark, d)).select(
        "source_id", "source", "keyword", "kind", "content_id")


# ============================================================ candidate selection (v_candidates)


CUTOFF = datetime(2024, 1, 22, 12, 0, 0)


@register("first_seen_candidates")
def q_first_seen_candidates(spark, d):
    return cd.first_seen(fx.candidates(spark, d))


@register("limit_per_job")
def q_limit_per_job(spark, d):
    return cd.limit_per_list(cd.first_seen(fx.candidates(spark, d)), limit=cd.DEFAULT_LIMIT).select(
        "keyword", "source", "content_id", "pos", "rank")


@register("takewhile_cutoff")
def q_takewhile_cutoff(spark, d):
    return cd.take_while_newer(fx.candidates(spark, d), CUTOFF).select(
        "keyword", "source", "content_id", "pos", "page")


@register("stop_on_repeat_page")
def q_stop_on_repeat_page(spark, d):
    return cd.stop_on_repeat_page(fx.candidates(spark, d), max_pages=cd.MAX_PAGES).select(
        "keyword", "source", "content_id", "pos", "page")


@register("cap_comments")
def q_cap_comments(spark, d):
    return cd.cap_per_content(fx.comments(spark, d), page_size=10, pages=cd.COMMENT_PAGES).select(
        "source_id", "source", "content_id", "turn", "rank")


@register("uncached_candidates")
def q_uncached_candidates(spark, d):
    return cd.uncached(fx.raw_pages(spark, d).select("ingest_seq", "url"), fx.url_cache(spark, d),
                       now_day=TODAY.date())


@register("ttl_dedupe")
def q_ttl_dedupe(spark, d):
    from murmur.sources.tables import read_table
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts",
                                               (F.col("event_id") % 37 == 0).alias("force"))
    out = cd.ttl_dedupe(ev, key="user_id", ts="ts", ttl_days=7, tiebreak="event_id", force_col="force")
    return out.select("user_id", "event_id", iso_ts("ts").alias("accepted_at"))


# ============================================================ raw zone, warehouse, cleaner


HWM = 100   # the stored checkpoint of the incremental scan


@register("raw_incremental_scan")
def q_raw_incremental_scan(spark, d):
    return wh.incremental_scan(fx.raw_pages(spark, d).select("ingest_seq", "type", "source", "url"), HWM)


@register("late_rows")
def q_late_rows(spark, d):
    return wh.late_rows(fx.raw_pages(spark, d).select("ingest_seq", "url"), HWM)


@register("find_page")
def q_find_page(spark, d):
    return wh.find_page(fx.contents(spark, d), F.col("keyword") == "en", ["source_id", "url", "ingest_seq"],
                        ["ingest_seq"], skip=20, limit=10)


@register("find_first")
def q_find_first(spark, d):
    return wh.find_first(fx.contents(spark, d).select("source_id", "keyword", "url", "ingest_seq"),
                         F.col("keyword") == "fr", [F.col("ingest_seq").desc()])


@register("count_where")
def q_count_where(spark, d):
    return wh.count_where(fx.contents(spark, d), (F.col("keyword") == "en") & (F.col("content_id") != ""))


@register("match_group_sort")
def q_match_group_sort(spark, d):
    return wh.match_group_sort(
        fx.contents(spark, d), F.col("content_id") != "", ["keyword"],
        [F.count(F.lit(1)).alias("n"), F.min("ingest_seq").alias("min_seq"), F.max("ingest_seq").alias("max_seq")],
        [F.col("n").desc(), "keyword"])


@register("warehouse_param_sql")
def q_warehouse_param_sql(spark, d):
    return wh.param_sql(
        spark,
        "SELECT source, count(*) AS n, round(avg(confidence), 6) AS avg_confidence FROM {op} "
        "WHERE keyword = :kw AND day >= :start GROUP BY source",
        args={"kw": "click", "start": date(2024, 1, 15)}, op=fx.opinions(spark, d))


@register("raw_append")
def q_raw_append(spark, d):
    rows = wh.with_ingest_timestamps(fx.raw_pages(spark, d).select("ingest_seq", "type", "source", "url"), TODAY)
    return rows.select("ingest_seq", "type", "source", "url", iso_ts("created_at").alias("created_at"))


def _keyed_contents(spark, d):
    c = fx.contents(spark, d)
    return c.select("source", first_nonblank("content_id", "url").alias("source_id"), "keyword", "url", "ingest_seq")


@register("insert_contents_new")
def q_insert_contents_new(spark, d):
    inc = _keyed_contents(spark, d)
    existing = inc.where(F.col("ingest_seq") % 5 == 0)
    return wh.new_rows(inc, existing, order_col="ingest_seq").select("source", "source_id", "keyword", "url")


@register("insert_comments_new")
def q_insert_comments_new(spark, d):
    inc = fx.comments(spark, d)
    existing = inc.where(F.col("content_id").cast("long") % 5 == 0)
    return wh.new_rows(inc, existing, order_col="turn").select("source", "source_id", "content_id", "author")


@register("upsert_rows")
def q_upsert_rows(spark, d):
    c = _keyed_contents(spark, d)
    target = c.where(F.col("ingest_seq") % 2 == 0).select("source", "source_id", "keyword", "url")
    updates = c.where(F.col("ingest_seq") % 3 == 0).select("source", "source_id", F.lit("updated").alias("keyword"), "url")
    return wh.keyed_update(target, updates, set_cols=("keyword",), upsert=True)


@register("delete_where")
def q_delete_where(spark, d):
    return wh.delete_where(fx.contents(spark, d), F.col("keyword") == "es").select("source_id", "keyword")


@register("route_by_type_source")
def q_route_by_type_source(spark, d):
    return cl.route(fx.raw_documents(spark, d)).select("ingest_seq", "type", "source", "parser")


@register("clean_rejects")
def q_clean_rejects(spark, d):
    return cl.rejects(fx.raw_documents(spark, d))


@register("source_registry_union")
def q_source_registry_union(spark, d):
    return _clean_contents(cl.clean(fx.raw_documents(spark, d))[0])


def _clean_contents(contents):
    from murmur.functions.hashing import hmac_sha256
    return contents.select("source", "source_id", "keyword", "title", hmac_sha256("author", SECRET).alias("author_hash"),
                           F.md5("content").alias("body_md5"), iso_ts("published_ts").alias("published_ts"))


@register("clean_contents")
def q_clean_contents(spark, d):
    """The cleaner over rows that the warehouse does not have (here: none yet), articles by key first."""
    raw = fx.raw_documents(spark, d)
    contents, _, _ = cl.clean(cl.fresh(raw, spark.createDataFrame([], "source string, source_id string")))
    return _clean_contents(contents)


@register("clean_comments")
def q_clean_comments(spark, d):
    from murmur.functions.hashing import hmac_sha256
    _, comments, _ = cl.clean(fx.raw_documents(spark, d))
    return comments.select("source", "source_id", "content_id", "raw_parent_id", hmac_sha256("author", SECRET).alias("author_hash"),
                           F.md5("content").alias("body_md5"), iso_ts("published_ts").alias("published_ts"))


def _opinions_from_raw(spark, d):
    contents, comments, _ = cl.clean(fx.raw_documents(spark, d))
    return contents, an.opinions_from_warehouse(contents, _unlabelled(comments))


def _unlabelled(comments):
    for c, t in (("sentiment", "string"), ("engine", "string"), ("confidence", "double")):
        comments = comments.withColumn(c, F.lit(None).cast(t))
    return comments.withColumn("ai_processed", F.lit(False))


@register("opinions_view")
def q_opinions_view(spark, d):
    return _opinions_from_raw(spark, d)[1].select("source", "source_id", "kind", "keyword", "content_id", F.md5("raw").alias("body_md5"),
                                                  iso_ts("published_ts").alias("published_ts"))


@register("comments_with_parent")
def q_comments_with_parent(spark, d):
    contents, op = _opinions_from_raw(spark, d)
    return an.feed_with_parent(op.where("kind = 'comment'"), contents).drop("sentiment")


def _warehouse_columns(rows, schema):
    """`rows` with exactly the schema's columns; those that are not there are NULL."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


@register("label_pass")
def q_label_pass(spark, d):
    """Comments inserted into a bucketed warehouse -> labels for the unprocessed (given as columns, by text
    length) -> the files that hold an answered row are rewritten."""
    from murmur import schemas as S
    from murmur.operators import buckets as bk
    from murmur.streaming.common import new_location
    n = F.length("content")

    def scorer(rows):
        label = F.when(n % 4 == 0, "positive").when(n % 4 == 1, "negative").when(n % 4 == 2, "neutral")
        scored = rows.select("source", "source_id", label.alias("sentiment"), ((n % 100) / F.lit(100.0)).alias("confidence"))
        return se.cascade_routing(scored).drop("needs_fallback")
    _, comments, _ = cl.clean(fx.raw_documents(spark, d))
    table = bk.BucketTable(spark, new_location(spark, "warehouse", "labelled"), S.COMMENTS, buckets=16)
    table.insert_ignore(_warehouse_columns(_unlabelled(comments), S.COMMENTS))
    bk.label_pass(table, scorer)
    return table.read().select("source", "source_id", "sentiment", "engine", F.round("confidence", 6).alias("confidence"), "ai_processed")


@register("run_totals")
def q_run_totals(spark, d):
    contents, comments, _ = cl.clean(fx.raw_documents(spark, d))
    return an.run_totals({"contents": contents, "comments": comments})


@register("extract_articles")
def q_extract_articles(spark, d):
    raw = fx.raw_documents(spark, d).where((F.col("type") == "content") & F.col("source").isin(*fx.NEWS_SOURCES))
    return X.extract_articles(raw).select("source_id", "source", "title", "author", "content", "published_at")


# ============================================================ extraction

def _raw_comments(spark, d, *sources):
    return fx.raw_documents(spark, d).where((F.col("type") == "comment") & F.col("source").isin(*sources))


@register("flatten_comment_threads")
def q_flatten_comment_threads(spark, d):
    return X.flatten_comment_threads(_raw_comments(spark, d, "detik", "cnn")).select(
        "source", "content_id", "raw_parent_id", "source_id", "author", "content", "prokontra", "published_at")


@register("flat_comments")
def q_flat_comments(spark, d):
    yt = X.flat_comments(_raw_comments(spark, d, "youtube"), "youtube")
    rd = X.flat_comments(_raw_comments(spark, d, "reddit"), "reddit")
    return yt.unionByName(rd).select("source", "source_id", "author", "content", "published_at")


@register("json_contents")
def q_json_contents(spark, d):
    raw = fx.raw_documents(spark, d).where(F.col("type") == "content")
    yt = X.json_contents(raw.where(F.col("source") == "youtube"), "youtube")
    rd = X.json_contents(raw.where(F.col("source") == "reddit"), "reddit")
    return yt.unionByName(rd).select("source_id", "source", "title", "author", "media", "content", "published_at")


@register("normalise_payload")
def q_normalise_payload(spark, d):
    from murmur.sources.tables import read_table
    ev = read_table(spark, d, "events").select(F.col("event_id").alias("ingest_seq"), F.col("props").alias("raw"))
    pg = read_table(spark, d, "pages").select((-F.col("page_id") - 1).alias("ingest_seq"), F.col("html").alias("raw"))
    return X.normalise_payload(ev.unionByName(pg))


@register("extract_page_meta")
def q_extract_page_meta(spark, d):
    return X.page_meta(fx.result_pages(spark, d)).withColumn("published_ts", iso_ts("published_ts"))


@register("extract_cards")
def q_extract_cards(spark, d):
    return X.extract_cards(fx.result_pages(spark, d)).withColumn("published_ts", iso_ts("published_ts"))


@register("url_parts")
def q_url_parts(spark, d):
    return X.url_parts(fx.raw_pages(spark, d))


@register("stable_ids")
def q_stable_ids(spark, d):
    from murmur.functions.hashing import make_id
    p = fx.raw_pages(spark, d)
    return p.select("ingest_seq", make_id("source", "content_id").alias("row_id"),
                    F.sha2("url", 256).alias("url_sha256"), F.sha1("url").alias("url_sha1"),
                    F.md5("url").alias("cache_key"))


@register("json_path")
def q_json_path(spark, d):
    from murmur.functions.json import json_path
    from murmur.sources.tables import read_table
    ev = read_table(spark, d, "events").select("event_id", "props")
    return ev.select("event_id", json_path("props", "$.k", default="0").alias("k"))


@register("json_deep_find")
def q_json_deep_find(spark, d):
    hits = X.json_deep_find(_raw_comments(spark, d, "detik", "cnn").select("ingest_seq", "raw"), "id")
    return hits.select("ingest_seq", "depth", "value", "first")


@register("extract_feed_entries")
def q_extract_feed_entries(spark, d):
    return X.extract_feed_entries(fx.feeds(spark, d))


@register("extract_json_items")
def q_extract_json_items(spark, d):
    return X.extract_json_items(fx.json_pages(spark, d))


@register("normalise_timestamps")
def q_normalise_timestamps(spark, d):
    t = fx.times(spark, d)
    return t.select("event_id", "published_at", iso_ts(parse_publish_time(F.col("published_at"))).alias("published_ts"))


# ============================================================ sentiment, privacy




@register("cascade_routing")
def q_cascade_routing(spark, d):
    return se.cascade_routing(fx.opinions(spark, d)).select("source_id", "source", "engine", "needs_fallback")


@register("engine_report")
def q_engine_report(spark, d):
    done = se.cascade_routing(fx.opinions(spark, d).where(F.col("ai_processed")))
    return an.engine_report(done)


def _classifier_answers(spark, d):
    """Labels for the unprocessed opinions as a classifier would return them (derived from the
    event payload; every 9th value gets no answer)."""
    from murmur.sources.tables import read_table
    ev = read_table(spark, d, "events").select("event_id", "user_id", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    u4 = (F.col("user_id") % 4).cast("int")
    return ev.where(F.col("event_id") % 10 == 0).select(
        F.when(u4 == 0, "reddit").when(u4 == 1, "youtube").when(u4 == 2, "detik").otherwise("cnn").alias("source"),
        F.col("event_id").cast("string").alias("source_id"),
        F.when(k % 9 == 0, F.lit(None)).when(k < 34, "negative").when(k < 67, "neutral")
        .otherwise("positive").alias("sentiment"),
        F.when(k / F.lit(100.0) >= se.CONFIDENCE_THRESHOLD, se.BULK).otherwise(se.FALLBACK).alias("engine"),
        (k / F.lit(100.0)).alias("confidence"))


@register("apply_sentiment_updates")
def q_apply_sentiment_updates(spark, d):
    op = fx.opinions(spark, d).select("source", "source_id", "sentiment", "confidence", "ai_processed")
    out = se.apply_labels(op, _classifier_answers(spark, d))
    return out.select("source_id", "source", "sentiment", "engine", F.round("confidence", 6).alias("confidence"),
                      "ai_processed")


@register("pseudonymise_authors")
def q_pseudonymise_authors(spark, d):
    from murmur.functions.hashing import hmac_sha256
    op = fx.opinions(spark, d)
    return op.select("source_id", "source", hmac_sha256("author", SECRET).alias("author_hash"))


@register("train_bulk_model")
def q_train_bulk_model(spark, d):
    lab = fx.labelled(spark, d)
    model = se.train_bulk_model(lab)
    return se.score_bulk(model, lab.select("doc_id", "content", "sentiment")).select(
        "doc_id", "sentiment", "bulk_label", F.round("bulk_confidence", 6).alias("bulk_confidence"))


@register("classify_cascade")
def q_classify_cascade(spark, d):
    from murmur.operators import cascade as ca
    from murmur.sources.tables import read_table
    model = ca.train_cascade(fx.labelled(spark, d))
    docs = read_table(spark, d, "documents").select("doc_id", F.col("text").alias("content"))
    return ca.classify(model, docs).select("doc_id", "sentiment", "engine", "confidence")


@register("cascade_quality")
def q_cascade_quality(spark, d):
    """Fitted on four fifths of the labelled texts, measured on the rest: accuracy and calibration error."""
    from murmur.operators import cascade as ca
    rows = fx.labelled(spark, d)
    held = ca.text_part("content", 5, "held") == 0
    model = ca.train_cascade(rows.where(~held))
    out = ca.cascade_quality(model, rows.where(held))
    return out.select("view", "n", F.round("accuracy", 6).alias("accuracy"), F.round("calibration_error", 6).alias("calibration_error"))


# ============================================================ jobs


def _valid_jobs(spark, d):
    return jb.validate(jb.decode(fx.job_messages(spark, d)))


@register("valid_jobs")
def q_valid_jobs(spark, d):
    return _valid_jobs(spark, d).select("job_id", "keyword", "interval", "platforms", "news_sources", "force", "limit")


@register("job_source_fanout")
def q_job_source_fanout(spark, d):
    return jb.fan_out(_valid_jobs(spark, d)).select("job_id", "keyword", "source")


@register("jobs_to_json")
def q_jobs_to_json(spark, d):
    return jb.to_messages(_valid_jobs(spark, d), key_col="job_id")


@register("job_candidates")
def q_job_candidates(spark, d):
    jobs = jb.fan_out(_valid_jobs(spark, d))
    picked = cd.select_candidates(jobs, fx.candidates(spark, d), fx.read_cache(spark, d), TODAY)
    return picked.groupBy("job_id", "source").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
                                                  F.max(F.col("rank").cast("long")).alias("last_rank"))


# ============================================================ streaming (batch twins compared)

@register("stream_daily_sentiment")
def q_stream_daily_sentiment(spark, d):
    from murmur.streaming.daily import run_daily_sentiment
    return run_daily_sentiment(spark, d)


@register("stream_ttl_dedupe")
def q_stream_ttl_dedupe(spark, d):
    from murmur.streaming.dedupe import run_ttl_dedupe
    out = run_ttl_dedupe(spark, d, ttl_days=7, force=F.col("event_id") % 37 == 0)
    return out.select("user_id", "event_id", iso_ts("ts").alias("accepted_at"))


@register("stream_job_fanout")
def q_stream_job_fanout(spark, d):
    from murmur.streaming.jobs import run_fanout
    return run_fanout(spark, d)


@register("job_stream_decode")
def q_job_stream_decode(spark, d):
    from murmur.streaming.jobs import run_decode
    return run_decode(spark, d).select("job_id", "keyword", "interval", "platforms", "news_sources", "force", "limit")


@register("json_dir_to_messages")
def q_json_dir_to_messages(spark, d):
    from murmur.streaming.jobs import run_json_dir
    return run_json_dir(spark, d)


@register("stream_clean")
def q_stream_clean(spark, d):
    from murmur.streaming.clean import run_clean
    from murmur.streaming.common import new_location
    raw_path = new_location(spark, "raw", "raw_documents")
    wh.append_raw(fx.raw_documents(spark, d), raw_path, now=TODAY)
    paths = run_clean(spark, raw_path, new_location(spark, "warehouse", "wh"), secret=SECRET)
    out = lambda name: spark.read.parquet(paths[name]).select(
        F.lit(name).alias("table_name"), "source", "source_id", "keyword", F.col("author").alias("author_hash"), F.md5("content").alias("body_md5"),
        iso_ts("published_ts").alias("published_ts"))
    return out("contents").unionByName(out("comments"))
