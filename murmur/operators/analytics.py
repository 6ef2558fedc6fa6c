"""Serving analytics over the opinions table.

Input `op` is an opinions DataFrame with at least: source_id, source, keyword, kind, content_id,
sentiment, confidence, day (DATE), published_ts (TIMESTAMP_NTZ). Every report aggregates first
(partial aggregation runs map-side, so a hot keyword or source is collapsed inside each task before
the shuffle) and only then applies windows, which therefore run over small aggregated rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.text import STOP_WORDS, words
from murmur.functions.times import in_window, ntz_literal

SENTIMENTS = ("positive", "negative", "neutral")
CONFIDENCE_THRESHOLD = 0.75


def _n() -> Column:
    return F.count(F.lit(1))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


# ---------------------------------------------------------------- C20 / H3 / G3: lists

def unified_feed(op: DataFrame, contents: DataFrame) -> DataFrame:
    """H3: opinions (comments, posts) and their context articles in one feed with a `kind` column."""
    ops = op.select("source_id", "source", "keyword", "kind", "content_id", "published_ts",
                    "sentiment", F.col("raw").alias("text"))
    ctx = contents.select("source_id", "source", "keyword", F.lit("context").alias("kind"), "content_id",
                          F.col("content").alias("text"))
    return ops.unionByName(ctx, allowMissingColumns=True)


def filter_feed(feed: DataFrame, *, keyword: str | None = None, source: str | None = None,
                window: str | None = None, today: datetime | None = None, sentiment: str | None = None,
                kind: str = "all") -> DataFrame:
    """C20: the `/opinions` list. Every predicate is optional; kind is all | opinion | context.

    Predicates are plain column comparisons, so they push through the union into both scans.
    """
    cond = F.lit(True)
    if keyword is not None:
        cond = cond & (F.col("keyword") == keyword)
    if source is not None:
        cond = cond & (F.col("source") == source)
    if sentiment is not None:
        cond = cond & (F.col("sentiment") == sentiment)
    if kind == "opinion":
        cond = cond & (F.col("kind") != "context")
    elif kind == "context":
        cond = cond & (F.col("kind") == "context")
    elif kind != "all":
        cond = cond & (F.col("kind") == kind)
    if window is not None:
        cond = cond & in_window("published_ts", window, today or datetime.now())
    return feed.where(cond)


def newest(op: DataFrame, k: int = 20) -> DataFrame:
    """The k newest opinions (top-k: each task keeps its k best, then one merge of k x tasks rows)."""
    return op.orderBy(F.col("published_ts").desc(), F.col("source_id").desc()).limit(k)


def opinions_from_warehouse(contents: DataFrame, comments: DataFrame) -> DataFrame:
    """Q18: the opinions view over the two warehouse tables: every comment, and the forum's posts
    (contents of `reddit`), which carry no label of their own. News and video bodies are context."""
    shared = ["source_id", "source", "keyword", "content_id", "author", F.col("content").alias("raw"), "published_ts"]
    labels = {"sentiment": "string", "engine": "string", "confidence": "double", "ai_processed": "boolean"}
    said = comments.select(*shared, F.lit("comment").alias("kind"), "raw_parent_id", *labels)
    posts = contents.where(F.col("source") == "reddit").select(
        *shared, F.lit("post").alias("kind"), F.lit(None).cast("string").alias("raw_parent_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in labels.items()])
    return said.unionByName(posts).withColumn("day", F.to_date("published_ts"))


def feed_with_parent(op: DataFrame, contents: DataFrame) -> DataFrame:
    """D3: each opinion with its parent article: by the raw row it names (`raw_parent_id` = `raw_id`),
    else by (source, content_id); blank ids never match.

    Contents are deduplicated on the join key first, so an opinion gets at most one parent. A viral
    article (hot content_id) is split by AQE's skew-join handling on the opinion side.
    """
    parent = F.struct("source", "url", "keyword")
    by_id = (contents.where(F.col("content_id") != "").groupBy("source", "content_id")
             .agg(F.min_by(parent, F.col("source_id")).alias("p")))
    out = op.join(by_id, ["source", "content_id"], "left")
    if "raw_parent_id" in op.columns and "raw_id" in contents.columns:
        by_raw = contents.groupBy(F.col("raw_id").cast("string").alias("raw_parent_id")).agg(F.min_by(parent, F.col("source_id")).alias("q"))
        out = out.join(by_raw, "raw_parent_id", "left").withColumn("p", F.coalesce("q", "p"))
    return out.select("source_id", "source", "content_id", "sentiment", F.col("p.source").alias("parent_source"),
                      F.col("p.url").alias("parent_url"), F.col("p.keyword").alias("parent_keyword"))


def contents_with_opinions(contents: DataFrame, op: DataFrame) -> DataFrame:
    """Context articles that have at least one opinion of their source (left semi join).

    The opinion side is reduced to distinct ids first (partial aggregation map-side), so a viral
    article's millions of comments become one row before the join's shuffle.
    """
    ids = op.select("source", "content_id").where(F.col("content_id") != "").distinct()
    return contents.join(ids, ["source", "content_id"], "left_semi")


# ---------------------------------------------------------------- E: aggregates

def run_totals(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per (table, source) of one run's outputs."""
    parts = [df.groupBy("source").agg(_n().alias("n")).select(F.lit(name).alias("table_name"), "source", "n")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sentiment_headline(op: DataFrame, window: str = "30d", today: datetime | None = None) -> DataFrame:
    """Per keyword, total opinions in the window and the share of each sentiment."""
    n = _n()
    return (op.where(in_window("published_ts", window, today or datetime.now()))
            .groupBy("keyword")
            .agg(n.alias("total"),
                 *[F.count_if(F.col("sentiment") == s).alias(f"n_{s}") for s in SENTIMENTS])
            .select("keyword", "total",
                    *[F.round(_share(F.col(f"n_{s}"), F.col("total")), 6).alias(f"pct_{s}") for s in SENTIMENTS]))


def sentiment_distribution(op: DataFrame) -> DataFrame:
    """Count and share of each sentiment per keyword."""
    agg = op.groupBy("keyword", "sentiment").agg(_n().alias("n"))
    w = Window.partitionBy("keyword")
    return agg.select("keyword", "sentiment", "n",
                      F.round(F.col("n") / F.sum("n").over(w), 6).alias("share"))


def keyword_sentiment_daily(op: DataFrame) -> DataFrame:
    """The daily snapshot keyword x day x sentiment with volume and mean confidence."""
    return op.groupBy("keyword", "day", "sentiment").agg(
        _n().alias("n"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))


def daily_signal(op: DataFrame) -> DataFrame:
    """E5: per keyword and day, the volume (all opinions) and the dominant sentiment among the
    labelled ones (ties -> last label A-Z; not-yet-classified rows never dominate)."""
    per = op.groupBy("keyword", "day", "sentiment").agg(_n().alias("n"))
    labelled = F.col("sentiment").isNotNull()
    return per.groupBy("keyword", "day").agg(
        F.sum("n").alias("volume"),
        F.max_by("sentiment", F.when(labelled, F.struct("n", "sentiment"))).alias("dominant_sentiment"),
        F.max(F.when(labelled, F.col("n"))).alias("dominant_n"))


def source_counts(op: DataFrame, contents: DataFrame) -> DataFrame:
    """Rows per source, tagged opinion (comments, posts) or context (articles)."""
    tagged = (op.select("source", F.lit("opinion").alias("tag"))
              .unionByName(contents.select("source", F.lit("context").alias("tag"))))
    return tagged.groupBy("source", "tag").agg(_n().alias("n"))


def top_words_by_sentiment(texts: DataFrame, k: int = 5, stop_words=STOP_WORDS) -> DataFrame:
    """The k most frequent words per sentiment, with bar = n / top word's n.

    Words are exploded inside each task and counted with partial aggregation, so a very common word
    costs one row per (task, word) in the shuffle. The per-sentiment top-k uses a rank window that
    Spark plans with a map-side WindowGroupLimit, so only k rows per task reach the final window.
    """
    stop = sorted(set(stop_words))
    w = (texts.select("sentiment", F.explode(words("content")).alias("word"))
         .where((F.col("word") != "") & ~F.col("word").isin(stop)))
    counts = w.groupBy("sentiment", "word").agg(_n().alias("n"))
    rank_w = Window.partitionBy("sentiment").orderBy(F.col("n").desc(), F.col("word"))
    top = counts.withColumn("rank", F.row_number().over(rank_w)).where(F.col("rank") <= k)
    return top.select("sentiment", "rank", "word", "n",
                      F.round(F.col("n") / F.max("n").over(Window.partitionBy("sentiment")), 6).alias("bar"))


def trending_keywords(op: DataFrame, days: int = 7, today: datetime | None = None) -> DataFrame:
    """Volume in the last `days` vs the preceding equal window, ordered by growth.

    growth = (now - before) / greatest(before, 1). Only the two windows are scanned (pushed filter).
    """
    hi = today or datetime.now()
    mid, lo = hi - timedelta(days=days), hi - timedelta(days=2 * days)
    ts = F.col("published_ts")
    cur = (ts >= ntz_literal(mid)) & (ts < ntz_literal(hi))
    agg = (op.where((ts >= ntz_literal(lo)) & (ts < ntz_literal(hi)))
           .groupBy("keyword")
           .agg(F.count_if(cur).alias("n_now"), F.count_if(~cur).alias("n_before")))
    return (agg.withColumn("growth", F.round((F.col("n_now") - F.col("n_before"))
                                             / F.greatest(F.col("n_before"), F.lit(1)), 6))
            .orderBy(F.col("growth").desc(), "keyword"))


def compare_keywords(op: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Keywords side by side: count and share of each sentiment (pivot with a fixed value list)."""
    src = op if not keywords else op.where(F.col("keyword").isin(keywords))
    piv = src.groupBy("keyword").pivot("sentiment", list(SENTIMENTS)).agg(_n()).na.fill(0, list(SENTIMENTS))
    total = sum((F.col(s) for s in SENTIMENTS), F.lit(0))
    return piv.select("keyword", *SENTIMENTS, total.alias("total"),
                      *[F.round(F.col(s) / total, 6).alias(f"share_{s}") for s in SENTIMENTS])


def engine_report(labelled: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Rows per engine, mean confidence and the share under the cascade threshold."""
    return labelled.groupBy("engine").agg(
        _n().alias("n"), F.round(F.avg("confidence"), 6).alias("avg_confidence"),
        F.round(F.count_if(F.col("confidence") < threshold) / _n(), 6).alias("share_low"))


def comments_per_content(op: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct comments per content (exact by default; HLL sketch when `approximate`)."""
    cnt = (F.approx_count_distinct("source_id") if approximate else F.count_distinct("source_id"))
    return op.groupBy("source", "content_id").agg(cnt.alias("n_comments"))


def opinion_rollup(op: DataFrame) -> DataFrame:
    """Keyword -> source -> total, with grouping level (0 leaf, 1 keyword, 3 grand total)."""
    return op.rollup("keyword", "source").agg(_n().alias("n"), F.grouping_id().alias("level"))


# ---------------------------------------------------------------- F: windows over aggregates

def _daily(op: DataFrame, label: str = "negative") -> DataFrame:
    return op.groupBy("keyword", "day").agg(_n().alias("n"), F.count_if(F.col("sentiment") == label).alias("n_label"))


def sentiment_shift_alert(op: DataFrame, label: str = "negative", threshold: float = 0.20,
                          min_n: int = 10) -> DataFrame:
    """day-over-day change of one sentiment's share; alert when |change| >= threshold and both
    days have at least `min_n` opinions. The lag runs over per-day aggregates (one row per day)."""
    d = _daily(op, label).withColumn("share", F.col("n_label") / F.col("n"))
    w = Window.partitionBy("keyword").orderBy("day")
    d = d.select("keyword", "day", "n", "share",
                 F.lag("share").over(w).alias("prev_share"), F.lag("n").over(w).alias("prev_n"))
    change = F.col("share") - F.col("prev_share")
    return d.select(
        "keyword", "day", "n", F.round("share", 6).alias("share"), F.round("prev_share", 6).alias("prev_share"),
        F.round(change, 6).alias("change"),
        F.coalesce((F.abs(change) >= threshold) & (F.col("n") >= min_n) & (F.col("prev_n") >= min_n),
                   F.lit(False)).alias("alert"))


def sentiment_gap_change(op: DataFrame, period_days: int = 7, today: datetime | None = None) -> DataFrame:
    """gap = positive share - negative share per period (0 = latest `period_days` days) and its
    change against the previous period."""
    t = (today or datetime.now()).date()
    period = F.floor(F.datediff(F.lit(t), F.col("day")) / F.lit(period_days)).cast("int")
    agg = (op.withColumn("period", period).groupBy("keyword", "period")
           .agg(_n().alias("n"), F.count_if(F.col("sentiment") == "positive").alias("n_pos"),
                F.count_if(F.col("sentiment") == "negative").alias("n_neg")))
    gap = (F.col("n_pos") - F.col("n_neg")) / F.col("n")
    w = Window.partitionBy("keyword").orderBy(F.col("period").desc())
    g = agg.select("keyword", "period", "n", gap.alias("gap"))
    g = g.withColumn("prev_gap", F.lag("gap").over(w))
    return g.select("keyword", "period", "n", F.round("gap", 6).alias("gap"), F.round("prev_gap", 6).alias("prev_gap"),
                    F.round(F.col("gap") - F.col("prev_gap"), 6).alias("change"))


def scaled_volume(op: DataFrame) -> DataFrame:
    """F8: daily volume per keyword scaled to the keyword's busiest day (bar height in [0, 1])."""
    d = op.groupBy("keyword", "day").agg(_n().alias("n"))
    return d.select("keyword", "day", "n",
                    F.round(F.col("n") / F.max("n").over(Window.partitionBy("keyword")), 6).alias("scaled"))


def write_daily_snapshot(op: DataFrame, path: str, days: list | None = None) -> None:
    """E4 sink: the `keyword_sentiment_daily` table, partitioned by day. Only the days present in
    the written rows are replaced (dynamic partition overwrite), so the daily job can recompute
    yesterday or backfill a range without touching other days; a rerun is idempotent."""
    src = op if not days else op.where(F.col("day").isin(days))
    (keyword_sentiment_daily(src).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
