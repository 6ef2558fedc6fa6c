"""Candidate selection: first-seen dedupe (F1), per-job cap (F2), take-while cutoff (F3),
repeat-page stop (F4), comment cap (F5), cache anti-join (D1); greedy TTL suppression (J3) is in `ttl`.

A candidate list is identified by (keyword, source) and ordered by `pos` (page, position on page).
The list-level rules are built from aggregates plus joins rather than windows over whole lists, so
a hot list is reduced map-side (partial aggregation) instead of being sorted inside one task.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.operators.ttl import ttl_dedupe  # noqa: F401

LIST_KEYS = ("keyword", "source")
#: Positions of a list that make a block of the two-level rank.
BLOCK = 4096
DEFAULT_LIMIT = 50          # contents per source per job
# Search pages per list and source, comment pages per content, and comments per page and source; None
# or 0 is no cap, the key None holds for all other sources.
MAX_PAGES = {None: 50, "youtube": 5}
COMMENT_PAGES = 10
PAGE_SIZE = {None: 10, "reddit": 100}


def per_source(value: int | dict | None, source_col: str = "source"):
    """A cap that is one number, or one per source, as a column; NULL where there is none."""
    sizes = value if isinstance(value, dict) else {None: value}
    out = F.lit(sizes.get(None) or None).cast("long")
    for name, size in sizes.items():
        if name is not None:
            out = F.when(F.col(source_col) == name, F.lit(size or None).cast("long")).otherwise(out)
    return out


def first_seen(cands: DataFrame, keys=LIST_KEYS, id_col: str = "content_id", carry=()) -> DataFrame:
    """F1/H4: keep each id's first occurrence in list order (min of (pos, page, *carry) per id).

    An aggregate, not a window: a repeated id collapses inside each task before the shuffle.
    `carry` names further columns to keep from the first occurrence.
    """
    k = list(keys)
    first = (cands.groupBy(*k, id_col)
             .agg(F.min(F.struct("pos", "page", *carry)).alias("f")))
    return first.select(*k, id_col, F.col("f.page").alias("page"), F.col("f.pos").alias("pos"),
                        *[F.col(f"f.{c}").alias(c) for c in carry])


def limit_per_list(cands: DataFrame, limit: int | str = DEFAULT_LIMIT, keys=LIST_KEYS) -> DataFrame:
    """the first `limit` candidates of each list, with their rank (0 = unlimited: rows unchanged,
    no rank, so no window over a whole list).

    `row_number() <= limit` is planned with a map-side WindowGroupLimit, so each task forwards at
    most `limit` rows per list to the final window.
    """
    if not limit:
        return cands
    w = Window.partitionBy(*keys).orderBy("pos")
    if isinstance(limit, str):       # a per-list limit column; 0 or NULL = unlimited
        cap = F.coalesce(F.col(limit), F.lit(0))
        largest = cands.agg(F.max(cap)).first()[0] or 0
        ranked = lambda df: df.withColumn("rank", F.row_number().over(w))
        top = ranked(cands.where(cap != 0)).where(F.col("rank") <= largest).where(F.col("rank") <= F.col(limit))
        return top.unionByName(ranked(cands.where(cap == 0)))
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def take_while_newer(cands: DataFrame, cutoff: datetime | str, keys=LIST_KEYS) -> DataFrame:
    """newest-first lists stop at the first dated item older than `cutoff`; undated items pass.
    `cutoff` is one time for all lists or the name of a per-row column (e.g. each job's window).

    The stop position per list is `min(pos)` of the old items (an aggregate); rows before it are
    kept. Equivalent to `sum(is_old) over (rows unbounded preceding) = 0`, without a list-wide sort.
    """
    k = list(keys)
    lit = F.col(cutoff) if isinstance(cutoff, str) else F.expr(f"TIMESTAMP_NTZ '{cutoff:%Y-%m-%d %H:%M:%S}'")
    stops = (cands.where(F.col("published_ts") < lit)
             .groupBy(*k).agg(F.min("pos").alias("stop_pos")))
    return (cands.join(stops, k, "left")
            .where(F.col("stop_pos").isNull() | (F.col("pos") < F.col("stop_pos")))
            .drop("stop_pos"))


def stop_on_repeat_page(cands: DataFrame, max_pages: int | dict | None = MAX_PAGES, keys=LIST_KEYS,
                        id_col: str = "content_id") -> DataFrame:
    """pagination ends before the first page that adds no new id, and after `max_pages` (one
    number, one per source, or None for no cap).

    first page per id (aggregate) -> pages that introduce an id -> first page of the list that
    introduces none (aggregate over the page set) -> keep rows on earlier pages.
    """
    k = list(keys)
    capped = cands if not max_pages else cands.where(F.coalesce(F.col("page") <= per_source(max_pages), F.lit(True)))
    intro = capped.groupBy(*k, id_col).agg(F.min("page").alias("page")).select(*k, "page").distinct()
    pages = capped.select(*k, "page").distinct()
    stops = (pages.join(intro, k + ["page"], "left_anti")
             .groupBy(*k).agg(F.min("page").alias("stop_page")))
    return (capped.join(stops, k, "left")
            .where(F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page")))
            .drop("stop_page"))


def cap_per_content(comments: DataFrame, page_size: int | dict = 10, pages: int | None = COMMENT_PAGES,
                    keys=("source", "content_id"), order_col: str = "turn") -> DataFrame:
    """at most `pages * page_size` comments per content, in fetch order; `page_size` is one number
    or one per source, `pages` None is no cap. The limit at the largest page is planned map-side
    (WindowGroupLimit); smaller pages are cut from what it leaves."""
    if not pages:
        return comments
    sizes = page_size if isinstance(page_size, dict) else {None: page_size}
    w = Window.partitionBy(*keys).orderBy(order_col)
    top = comments.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= pages * max(sizes.values()))
    return top.where(F.col("rank") <= pages * per_source(sizes)) if len(sizes) > 1 else top


def uncached(cands: DataFrame, cache: DataFrame, now_day: date, force: bool | str = False,
             url_col: str = "url") -> DataFrame:
    """Candidates whose md5(url) has no live cache entry, plus forced ones (`force` is a flag
    for all rows or the name of a per-row boolean column, e.g. the job's force).

    Left anti join on the cache key; AQE turns it into a broadcast only when the measured live
    cache is under the broadcast threshold, otherwise it stays a sort-merge join.
    """
    keyed = cands.withColumn("cache_key", F.md5(F.col(url_col)))
    if force is True:
        return keyed
    live = cache.where(F.col("expires_on") > F.lit(now_day)).select("cache_key")
    if not force:
        return keyed.join(live, "cache_key", "left_anti")
    forced = F.coalesce(F.col(force), F.lit(False))
    return keyed.where(~forced).join(live, "cache_key", "left_anti").unionByName(keyed.where(forced))


def ranked_in_blocks(items: DataFrame, keys=LIST_KEYS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rank and running oldest `published_ts` of each list's items in `pos` order, as a prefix scan of two
    levels: blocks of positions are counted and their oldest times taken (aggregates), offsets run over
    blocks only, and each block is ranked on its own. Returns (items with `block`, `rank`, `oldest`; per
    block its number of items, the items `before` it and their oldest time `low`)."""
    k = list(keys)
    items = items.withColumn("block", F.coalesce(F.floor(F.col("pos") / block).cast("long"), F.lit(-1)))
    w = Window.partitionBy(*k).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = items.groupBy(*k, "block").agg(F.count(F.lit(1)).alias("n"), F.min("published_ts").alias("least")) \
        .select(*k, "block", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"), F.min("least").over(w).alias("low"))
    inner = Window.partitionBy(*k, "block").orderBy("pos")
    running = F.min("published_ts").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = items.withColumn("_rank", F.row_number().over(inner)).withColumn("_oldest", running).join(blocks.drop("n"), [*k, "block"]) \
        .withColumn("rank", F.col("_rank") + F.col("before")).withColumn("oldest", F.least("_oldest", "low"))
    return ranked.drop("_rank", "_oldest", "before", "low"), blocks


def select_candidates(jobs: DataFrame, cands: DataFrame, cache: DataFrame, now: datetime,
                      url_of=None, max_pages: int | dict | None = MAX_PAGES) -> DataFrame:
    """The keyword-job path as one plan: each list's repeat-page stop (F4) -> first
    occurrence per id (F1) -> per job the items before the first one older than its window (F3), up to
    its limit, 0 = none (F2) -> cache anti join unless the job is forced (D1). The limit is applied
    before the cache check, as upstream (Q4): a rerun may select nothing.

    `jobs` carry job_id, keyword, interval, force, limit and a `source` per requested source (the
    fan-out); `cands` carry keyword, source, content_id, published_ts, pos, page. F4 and F1 are worked
    out per list, once, and each item gets its rank and the oldest time up to it, without a window over
    a whole list. A job first meets the blocks of its lists that its rules reach, then the items of
    these blocks, with both rules as conditions of the join.
    """
    from murmur.functions.times import window_start_col
    j = jobs.select("job_id", *LIST_KEYS, F.coalesce("force", F.lit(False)).alias("force"), F.coalesce("limit", F.lit(0)).alias("limit"),
                    window_start_col("interval", now).alias("cutoff"))
    seen = first_seen(stop_on_repeat_page(cands, max_pages), carry=("published_ts",))
    ranked, blocks = ranked_in_blocks(seen)
    cut = lambda before, low: ((F.col("limit") == 0) | (before < F.col("limit"))) & (low.isNull() | (low >= F.col("cutoff")))
    j = j.join(blocks, list(LIST_KEYS)).where(cut(F.col("before"), F.col("low"))).drop("n", "before", "low")
    url = url_of(F.col("source"), F.col("content_id")) if url_of else \
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/read/"), F.col("content_id"))
    r, a = ranked.withColumn("url", url).alias("r"), j.alias("a")
    same = [F.col(f"r.{k}") == F.col(f"a.{k}") for k in (*LIST_KEYS, "block")]
    wanted = cut(F.col("rank") - 1, F.col("oldest"))
    picked = a.join(r, [*same, wanted]).select("a.job_id", "r.keyword", "r.source", "content_id", "pos", "page", "rank", "published_ts", "force", "url")
    return uncached(picked, cache, now.date(), force="force")
