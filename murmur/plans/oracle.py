"""DuckDB oracle SQL for the query catalogue.

The oracle sees only the base tables, so every text inlines the fixture views as CTEs (the same
definitions as ``murmur.fixtures``). Now is pinned to 2024-01-30.
"""

from __future__ import annotations

from murmur.functions.text import STOP_WORDS

SECRET = "murmur-pseudonym-key"   # the catalogue's demonstration key

VIEWS = {
    "v_opinions": """
  SELECT CAST(event_id AS VARCHAR) AS source_id,
    CASE CAST(user_id % 4 AS INTEGER) WHEN 0 THEN 'reddit' WHEN 1 THEN 'youtube' WHEN 2 THEN 'detik' ELSE 'cnn' END AS source,
    event_type AS keyword,
    CASE WHEN user_id % 4 = 0 AND event_id % 5 = 0 THEN 'post' ELSE 'comment' END AS kind,
    CAST(user_id AS VARCHAR) AS content_id, CAST(user_id AS VARCHAR) AS author, props AS raw,
    CASE WHEN value < 10 THEN 'neutral' WHEN value < 40 THEN 'negative' ELSE 'positive' END AS sentiment,
    CASE WHEN event_id % 10 = 0 THEN FALSE ELSE TRUE END AS ai_processed,
    (event_id % 100) / CAST(100 AS DOUBLE) AS confidence,
    CAST(ts AS DATE) AS day, ts AS published_ts FROM events""",
    "v_candidates": """
  SELECT keyword, source, content_id, published_ts, CAST(pos AS BIGINT) AS pos,
    CAST(floor((pos - 1) / CAST(20 AS DOUBLE)) AS BIGINT) + 1 AS page FROM (
    SELECT event_type AS keyword, CASE WHEN event_id % 2 = 0 THEN 'cnn' ELSE 'liputan6' END AS source,
      CAST(user_id AS VARCHAR) AS content_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS published_ts,
      row_number() OVER (PARTITION BY event_type, event_id % 2
                         ORDER BY floor(event_id / CAST(500 AS DOUBLE)) DESC, event_id) AS pos FROM events) t""",
    "v_contents": """
  SELECT CAST(doc_id AS VARCHAR) AS source_id, source, lang AS keyword,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS content_id,
    concat('https://', source, '.example/', CAST(doc_id AS VARCHAR)) AS url, text AS content, doc_id AS ingest_seq
  FROM documents""",
    "v_comments": """
  SELECT concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS source_id, CAST(conv_id AS VARCHAR) AS content_id,
    turn, role AS author, text AS content,
    CASE CAST(conv_id % 2 AS INTEGER) WHEN 0 THEN 'detik' ELSE 'cnn' END AS source FROM conversations""",
    "v_labelled": """
  SELECT d.doc_id, d.source, d.lang AS keyword, d.text AS content,
    CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "v_raw_pages": """
  SELECT page_id AS ingest_seq, 'content' AS type, regexp_extract(url, '^https?://([^/]+)/', 1) AS source,
    regexp_extract(url, '/([a-z][a-z])/([0-9]+)', 1) AS keyword, url,
    regexp_extract(url, '/([a-z][a-z])/([0-9]+)', 2) AS content_id, html AS raw FROM pages""",
    "v_cache": """
  SELECT md5(url) AS cache_key,
    CASE WHEN page_id % 2 = 0 THEN DATE '2024-02-15' ELSE DATE '2024-01-10' END AS expires_on
  FROM pages WHERE page_id % 3 = 0""",
}


def W(*names: str) -> str:
    """WITH clause defining the named fixture views."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)


def _day(c: str = "day") -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_WORD_SPLIT = r"[^\p{L}0-9]+"

ORACLE: dict[str, str] = {}

# ============================================================ serving analytics (v_opinions)

ORACLE["keyword_sentiment_daily"] = f"""{W('v_opinions')}
SELECT keyword, {_day()} AS day, sentiment, count(*) AS n, round(avg(confidence), 6) AS avg_confidence
FROM v_opinions GROUP BY keyword, day, sentiment"""

ORACLE["daily_signal"] = f"""{W('v_opinions')},
per AS (SELECT keyword, day, sentiment, count(*) AS n FROM v_opinions GROUP BY keyword, day, sentiment)
SELECT keyword, {_day()} AS day, CAST(sum(n) AS BIGINT) AS volume,
  arg_max(sentiment, (n, sentiment)) FILTER (WHERE sentiment IS NOT NULL) AS dominant_sentiment,
  max(n) FILTER (WHERE sentiment IS NOT NULL) AS dominant_n
FROM per GROUP BY keyword, day"""

ORACLE["opinions_filter"] = f"""{W('v_opinions', 'v_contents')},
feed AS (SELECT source_id, source, keyword, kind, sentiment, published_ts FROM v_opinions
         UNION ALL SELECT source_id, source, keyword, 'context', NULL, NULL FROM v_contents)
SELECT source_id, source, keyword, kind, sentiment, {_ts('published_ts')} AS published_at FROM feed
WHERE keyword = 'view' AND sentiment = 'negative' AND kind <> 'context'
  AND published_ts >= TIMESTAMP '2024-01-10 00:00:00' AND published_ts < TIMESTAMP '2024-01-21 00:00:00'"""

ORACLE["unprocessed_comments"] = f"""{W('v_opinions')}
SELECT source_id, source, keyword, raw AS content FROM v_opinions WHERE NOT ai_processed AND raw IS NOT NULL"""

ORACLE["sentiment_headline"] = f"""{W('v_opinions')}
SELECT keyword, count(*) AS total,
  round(count_if(sentiment = 'positive') / count(*), 6) AS pct_positive,
  round(count_if(sentiment = 'negative') / count(*), 6) AS pct_negative,
  round(count_if(sentiment = 'neutral') / count(*), 6) AS pct_neutral
FROM v_opinions
WHERE published_ts >= TIMESTAMP '2023-12-31 00:00:00' AND published_ts < TIMESTAMP '2024-01-31 00:00:00'
GROUP BY keyword"""

ORACLE["sentiment_distribution"] = f"""{W('v_opinions')},
a AS (SELECT keyword, sentiment, count(*) AS n FROM v_opinions GROUP BY keyword, sentiment)
SELECT keyword, sentiment, n, round(n / sum(n) OVER (PARTITION BY keyword), 6) AS share FROM a"""

ORACLE["source_counts"] = f"""{W('v_opinions', 'v_contents')}
SELECT source, tag, count(*) AS n FROM (
  SELECT source, 'opinion' AS tag FROM v_opinions UNION ALL SELECT source, 'context' AS tag FROM v_contents) t
GROUP BY source, tag"""

ORACLE["top_words_by_sentiment"] = f"""{W('v_labelled')},
w AS (SELECT sentiment, unnest(regexp_split_to_array(lower(content), '{_WORD_SPLIT}')) AS word FROM v_labelled),
c AS (SELECT sentiment, word, count(*) AS n FROM w WHERE word <> '' AND word NOT IN ({_STOP}) GROUP BY sentiment, word),
r AS (SELECT sentiment, word, n, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, word) AS INTEGER) AS rank FROM c)
SELECT sentiment, rank, word, n, round(n / max(n) OVER (PARTITION BY sentiment), 6) AS bar FROM r WHERE rank <= 5"""

ORACLE["trending_keywords"] = f"""{W('v_opinions')},
a AS (SELECT keyword,
    CAST(count_if(published_ts >= TIMESTAMP '2024-01-23 00:00:00' AND published_ts < TIMESTAMP '2024-01-30 00:00:00') AS BIGINT) AS n_now,
    CAST(count_if(NOT (published_ts >= TIMESTAMP '2024-01-23 00:00:00' AND published_ts < TIMESTAMP '2024-01-30 00:00:00')) AS BIGINT) AS n_before
  FROM v_opinions
  WHERE published_ts >= TIMESTAMP '2024-01-16 00:00:00' AND published_ts < TIMESTAMP '2024-01-30 00:00:00'
  GROUP BY keyword)
SELECT keyword, n_now, n_before, round((n_now - n_before) / greatest(n_before, 1), 6) AS growth FROM a"""

ORACLE["compare_keywords"] = f"""{W('v_opinions')},
a AS (SELECT keyword, CAST(count_if(sentiment = 'positive') AS BIGINT) AS positive,
        CAST(count_if(sentiment = 'negative') AS BIGINT) AS negative,
        CAST(count_if(sentiment = 'neutral') AS BIGINT) AS neutral FROM v_opinions GROUP BY keyword)
SELECT keyword, positive, negative, neutral, positive + negative + neutral AS total,
  round(positive / (positive + negative + neutral), 6) AS share_positive,
  round(negative / (positive + negative + neutral), 6) AS share_negative,
  round(neutral / (positive + negative + neutral), 6) AS share_neutral FROM a"""

ORACLE["comments_per_content"] = f"""{W('v_opinions')}
SELECT source, content_id, count(DISTINCT source_id) AS n_comments FROM v_opinions GROUP BY source, content_id"""

ORACLE["opinion_rollup"] = f"""{W('v_opinions')}
SELECT keyword, source, count(*) AS n, CAST(GROUPING(keyword, source) AS BIGINT) AS level
FROM v_opinions GROUP BY ROLLUP (keyword, source)"""

ORACLE["kept_headline"] = ORACLE["sentiment_headline"]
ORACLE["kept_compare"] = ORACLE["compare_keywords"]
ORACLE["kept_serving"] = f"""{W('v_opinions')}
SELECT keyword, source, {_day()} AS day, sentiment, count(*) AS n, round(avg(confidence), 6) AS avg_confidence FROM v_opinions
WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY keyword, source, day, sentiment"""

ORACLE["sentiment_shift_alert"] = f"""{W('v_opinions')},
d AS (SELECT keyword, day, count(*) AS n, count_if(sentiment = 'negative') AS n_label FROM v_opinions GROUP BY keyword, day),
s AS (SELECT keyword, day, n, n_label / n AS share,
        lag(n_label / n) OVER (PARTITION BY keyword ORDER BY day) AS prev_share,
        lag(n) OVER (PARTITION BY keyword ORDER BY day) AS prev_n FROM d)
SELECT keyword, {_day()} AS day, n, round(share, 6) AS share, round(prev_share, 6) AS prev_share,
  round(share - prev_share, 6) AS change,
  coalesce(abs(share - prev_share) >= 0.2 AND n >= 10 AND prev_n >= 10, FALSE) AS alert FROM s"""

ORACLE["sentiment_gap_change"] = f"""{W('v_opinions')},
a AS (SELECT keyword, CAST(floor(date_diff('day', day, DATE '2024-01-30') / 7) AS INTEGER) AS period,
        count(*) AS n, count_if(sentiment = 'positive') AS n_pos, count_if(sentiment = 'negative') AS n_neg
      FROM v_opinions GROUP BY 1, 2),
g AS (SELECT keyword, period, n, (n_pos - n_neg) / n AS gap FROM a),
l AS (SELECT *, lag(gap) OVER (PARTITION BY keyword ORDER BY period DESC) AS prev_gap FROM g)
SELECT keyword, period, n, round(gap, 6) AS gap, round(prev_gap, 6) AS prev_gap, round(gap - prev_gap, 6) AS change FROM l"""

ORACLE["scaled_volume"] = f"""{W('v_opinions')},
d AS (SELECT keyword, day, count(*) AS n FROM v_opinions GROUP BY keyword, day)
SELECT keyword, {_day()} AS day, n, round(n / max(n) OVER (PARTITION BY keyword), 6) AS scaled FROM d"""

ORACLE["newest_opinions"] = f"""{W('v_opinions')}
SELECT source_id, source, keyword, sentiment, {_ts('published_ts')} AS published_at FROM v_opinions
ORDER BY published_ts DESC, source_id DESC LIMIT 20"""

ORACLE["window_filter"] = f"""{W('v_opinions')}
SELECT source_id, keyword, {_ts('published_ts')} AS published_at FROM v_opinions
WHERE published_ts >= TIMESTAMP '2024-01-23 00:00:00' AND published_ts < TIMESTAMP '2024-01-31 00:00:00'"""

ORACLE["recency_bucket"] = f"""{W('v_opinions')},
a AS (SELECT keyword, date_diff('day', day, DATE '2024-01-30') AS age FROM v_opinions)
SELECT keyword, CASE WHEN age <= 1 THEN 'today' WHEN age <= 7 THEN 'week' WHEN age <= 30 THEN 'month' ELSE 'year' END AS bucket,
  count(*) AS n FROM a GROUP BY 1, 2"""

# ============================================================ opinions + contents

# articles of four sources, three of them sharing each content id
VIEWS["v_articles"] = """
  SELECT CAST(doc_id AS VARCHAR) AS source_id, ['reddit', 'youtube', 'detik', 'cnn'][doc_id % 4 + 1] AS source, lang AS keyword,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE CAST(doc_id // 3 AS VARCHAR) END AS content_id,
    concat('https://', source, '.example/', CAST(doc_id AS VARCHAR)) AS url FROM documents"""

ORACLE["feed_with_parent"] = f"""{W('v_opinions', 'v_articles')},
p AS (SELECT source, content_id, arg_min(url, source_id) AS parent_url,
        arg_min(keyword, source_id) AS parent_keyword FROM v_articles WHERE content_id <> '' GROUP BY source, content_id)
SELECT o.source_id, o.source, o.content_id, o.sentiment, p.source AS parent_source, p.parent_url, p.parent_keyword
FROM v_opinions o LEFT JOIN p ON o.content_id = p.content_id AND o.source = p.source"""

ORACLE["contents_with_opinions"] = f"""{W('v_opinions', 'v_articles')}
SELECT c.source_id, c.source, c.keyword, c.content_id, c.url FROM v_articles c
WHERE EXISTS (SELECT 1 FROM v_opinions o WHERE o.content_id = c.content_id AND o.source = c.source AND o.content_id <> '')"""

ORACLE["unified_feed"] = f"""{W('v_opinions', 'v_contents')}
SELECT source_id, source, keyword, kind, content_id FROM v_opinions
UNION ALL SELECT source_id, source, keyword, 'context' AS kind, content_id FROM v_contents"""

# ============================================================ candidate selection (v_candidates)

ORACLE["first_seen_candidates"] = f"""{W('v_candidates')},
r AS (SELECT *, row_number() OVER (PARTITION BY keyword, source, content_id ORDER BY page, pos) AS rn FROM v_candidates)
SELECT keyword, source, content_id, page, pos FROM r WHERE rn = 1"""

ORACLE["limit_per_job"] = f"""{W('v_candidates')},
r AS (SELECT *, row_number() OVER (PARTITION BY keyword, source, content_id ORDER BY page, pos) AS rn FROM v_candidates),
f AS (SELECT keyword, source, content_id, pos FROM r WHERE rn = 1),
l AS (SELECT *, CAST(row_number() OVER (PARTITION BY keyword, source ORDER BY pos) AS INTEGER) AS rank FROM f)
SELECT keyword, source, content_id, pos, rank FROM l WHERE rank <= 50"""

ORACLE["takewhile_cutoff"] = f"""{W('v_candidates')},
s AS (SELECT *, sum(CASE WHEN published_ts < TIMESTAMP '2024-01-22 12:00:00' THEN 1 ELSE 0 END)
        OVER (PARTITION BY keyword, source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_old
      FROM v_candidates)
SELECT keyword, source, content_id, pos, page FROM s WHERE n_old = 0"""

ORACLE["stop_on_repeat_page"] = f"""{W('v_candidates')},
r AS (SELECT *, row_number() OVER (PARTITION BY keyword, source, content_id ORDER BY pos) AS rn FROM v_candidates),
p AS (SELECT keyword, source, page, sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS n_new FROM r GROUP BY keyword, source, page),
s AS (SELECT keyword, source, min(CASE WHEN n_new = 0 THEN page END) AS stop_page FROM p WHERE page <= 50 GROUP BY keyword, source)
SELECT c.keyword, c.source, c.content_id, c.pos, c.page FROM v_candidates c JOIN s USING (keyword, source)
WHERE c.page <= 50 AND (s.stop_page IS NULL OR c.page < s.stop_page)"""

ORACLE["cap_comments"] = f"""{W('v_comments')},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, content_id ORDER BY turn) AS INTEGER) AS rank FROM v_comments)
SELECT source_id, source, content_id, turn, rank FROM r WHERE rank <= 100"""

ORACLE["uncached_candidates"] = f"""{W('v_raw_pages', 'v_cache')}
SELECT p.ingest_seq, p.url, md5(p.url) AS cache_key FROM v_raw_pages p
WHERE NOT EXISTS (SELECT 1 FROM v_cache c WHERE c.cache_key = md5(p.url) AND c.expires_on > DATE '2024-01-30')"""

ORACLE["ttl_dedupe"] = """WITH RECURSIVE acc(user_id, ts, event_id) AS (
  SELECT user_id, ts, event_id FROM (
    SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) f
  WHERE rn = 1
  UNION ALL
  SELECT n.user_id, n.ts, n.event_id FROM acc,
    LATERAL (SELECT e.user_id, e.ts, e.event_id FROM events e
             WHERE e.user_id = acc.user_id
               AND (e.ts > acc.ts OR (e.ts = acc.ts AND e.event_id > acc.event_id))
               AND (e.event_id % 37 = 0 OR e.ts >= acc.ts + INTERVAL 7 DAY)
             ORDER BY e.ts, e.event_id LIMIT 1) n)
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS accepted_at FROM acc"""

# ============================================================ raw zone, warehouse, cleaner

_CSRC = "['detik','cnn','liputan6','merdeka','youtube','reddit','kompas']"
_MSRC = "['detik','cnn','youtube','reddit','kompas']"

# raw-zone envelope of murmur.fixtures.raw_documents (payloads are not needed by these oracles)
VIEWS["v_raw_env"] = f"""
  SELECT 2 * doc_id AS ingest_seq, 'content' AS type, {_CSRC}[doc_id % 7 + 1] AS source, doc_id, NULL AS conv_id
  FROM documents
  UNION ALL
  SELECT 2 * (1048576 * conv_id + turn) + 1, 'comment', {_MSRC}[conv_id % 5 + 1], NULL, conv_id
  FROM conversations WHERE conv_id % 5 >= 2
  UNION ALL
  SELECT DISTINCT 2097152 * conv_id + 1, 'comment', {_MSRC}[conv_id % 5 + 1], NULL, conv_id
  FROM conversations WHERE conv_id % 5 < 2"""

# contents the cleaner produces from murmur.fixtures.raw_documents
VIEWS["v_clean_contents"] = f"""
  SELECT source, lang AS keyword, doc_id,
    CASE WHEN doc_id % 11 <> 0 THEN CAST(doc_id AS VARCHAR)
         WHEN source = 'reddit' AND doc_id % 13 <> 0 THEN 'p' || CAST(doc_id AS VARCHAR)
         ELSE 'https://' || source || '.example/read/' || CAST(doc_id AS VARCHAR) END AS source_id,
    CASE WHEN source IN ('detik', 'cnn') THEN 'Card ' || CAST(doc_id AS VARCHAR)
         WHEN source IN ('liputan6', 'merdeka') THEN 'Story ' || CAST(doc_id AS VARCHAR)
         WHEN doc_id % 13 = 0 THEN '' ELSE 'Post ' || CAST(doc_id AS VARCHAR) END AS title
  FROM (SELECT doc_id, lang, text, {_CSRC}[doc_id % 7 + 1] AS source FROM documents) d
  WHERE source <> 'kompas' AND NOT (source IN ('detik', 'cnn', 'liputan6', 'merdeka') AND doc_id % 13 = 0)"""

VIEWS["v_conv_ts"] = f"""
  SELECT *, {_MSRC}[conv_id % 5 + 1] AS source,
    make_timestamp(CAST(1704067200 + conv_id * 3600 + turn * 60 AS BIGINT) * 1000000) AS cts
  FROM conversations"""

ORACLE["raw_incremental_scan"] = f"""{W('v_raw_pages')}
SELECT ingest_seq, type, source, url FROM v_raw_pages WHERE ingest_seq > 100 ORDER BY ingest_seq"""

ORACLE["late_rows"] = f"""{W('v_raw_pages')}
SELECT ingest_seq, url, 'late' AS reason FROM v_raw_pages WHERE ingest_seq <= 100"""

ORACLE["find_page"] = f"""{W('v_contents')}
SELECT source_id, url, ingest_seq FROM v_contents WHERE keyword = 'en' ORDER BY ingest_seq LIMIT 10 OFFSET 20"""

ORACLE["find_first"] = f"""{W('v_contents')}
SELECT source_id, keyword, url, ingest_seq FROM v_contents WHERE keyword = 'fr' ORDER BY ingest_seq DESC LIMIT 1"""

ORACLE["count_where"] = f"""{W('v_contents')}
SELECT count(*) AS n FROM v_contents WHERE keyword = 'en' AND content_id <> ''"""

ORACLE["match_group_sort"] = f"""{W('v_contents')}
SELECT keyword, count(*) AS n, min(ingest_seq) AS min_seq, max(ingest_seq) AS max_seq FROM v_contents
WHERE content_id <> '' GROUP BY keyword ORDER BY n DESC, keyword"""

ORACLE["warehouse_param_sql"] = f"""{W('v_opinions')}
SELECT source, count(*) AS n, round(avg(confidence), 6) AS avg_confidence FROM v_opinions
WHERE keyword = 'click' AND day >= DATE '2024-01-15' GROUP BY source"""

ORACLE["raw_append"] = f"""{W('v_raw_pages')}
SELECT ingest_seq, type, source, url, '2024-01-30 00:00:00' AS created_at FROM v_raw_pages"""

_KEYED = """k AS (SELECT source, coalesce(nullif(content_id, ''), url) AS source_id, keyword, url, ingest_seq FROM v_contents)"""

ORACLE["insert_contents_new"] = f"""{W('v_contents')}, {_KEYED},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY ingest_seq) AS rn FROM k) t WHERE rn = 1)
SELECT source, source_id, keyword, url FROM f
WHERE NOT EXISTS (SELECT 1 FROM k e WHERE e.ingest_seq % 5 = 0 AND e.source = f.source AND e.source_id = f.source_id)"""

ORACLE["insert_comments_new"] = f"""{W('v_comments')},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY turn) AS rn FROM v_comments) t WHERE rn = 1)
SELECT source, source_id, content_id, author FROM f
WHERE NOT EXISTS (SELECT 1 FROM v_comments e WHERE CAST(e.content_id AS BIGINT) % 5 = 0
                  AND e.source = f.source AND e.source_id = f.source_id)"""

ORACLE["upsert_rows"] = f"""{W('v_contents')}, {_KEYED},
t AS (SELECT source, source_id, keyword, url FROM k WHERE ingest_seq % 2 = 0),
u AS (SELECT source, source_id, 'updated' AS keyword, url FROM k WHERE ingest_seq % 3 = 0)
SELECT coalesce(t.source, u.source) AS source, coalesce(t.source_id, u.source_id) AS source_id,
  CASE WHEN u.source IS NOT NULL THEN u.keyword ELSE t.keyword END AS keyword,
  CASE WHEN t.source IS NULL THEN u.url ELSE t.url END AS url
FROM t FULL JOIN u ON t.source = u.source AND t.source_id = u.source_id"""

ORACLE["delete_where"] = f"""{W('v_contents')}
SELECT source_id, keyword FROM v_contents WHERE NOT coalesce(keyword = 'es', FALSE)"""

ORACLE["route_by_type_source"] = f"""{W('v_raw_env')}
SELECT ingest_seq, type, source,
  CASE WHEN type = 'content' AND source IN ('detik', 'cnn', 'liputan6', 'merdeka') THEN 'html_article'
       WHEN type = 'content' AND source = 'youtube' THEN 'video_json'
       WHEN type = 'content' AND source = 'reddit' THEN 'forum_json'
       WHEN type = 'comment' AND source IN ('detik', 'cnn') THEN 'thread_json'
       WHEN type = 'comment' AND source = 'youtube' THEN 'video_comment'
       WHEN type = 'comment' AND source = 'reddit' THEN 'forum_comment'
       ELSE 'none' END AS parser
FROM v_raw_env"""

ORACLE["clean_rejects"] = f"""{W('v_raw_env')},
r AS (SELECT ingest_seq, type, source,
  CASE WHEN source = 'kompas' THEN 'no parser'
       WHEN type = 'content' AND source IN ('detik', 'cnn', 'liputan6', 'merdeka') AND doc_id % 13 = 0 THEN 'empty payload'
  END AS reason FROM v_raw_env)
SELECT * FROM r WHERE reason IS NOT NULL"""

ORACLE["source_registry_union"] = f"""{W('v_clean_contents')}
SELECT source, source_id, keyword, title FROM v_clean_contents"""

ORACLE["run_totals"] = f"""{W('v_clean_contents', 'v_conv_ts')}
SELECT 'contents' AS table_name, source, count(*) AS n FROM v_clean_contents GROUP BY source
UNION ALL
SELECT 'comments', source, count(*) FROM v_conv_ts WHERE source <> 'kompas' GROUP BY source"""

# ============================================================ extraction

ORACLE["flatten_comment_threads"] = f"""{W('v_conv_ts')}
SELECT source, CAST(conv_id AS VARCHAR) AS content_id, CAST(2 * conv_id AS VARCHAR) AS raw_parent_id,
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS source_id, role AS author, text AS content,
  CASE WHEN turn = 0 THEN 'pro' END AS prokontra, strftime(cts, '%Y-%m-%d %H:%M:%S') AS published_at
FROM v_conv_ts WHERE source IN ('detik', 'cnn')"""

ORACLE["flat_comments"] = f"""{W('v_conv_ts')}
SELECT source, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS source_id, role AS author, text AS content,
  CASE WHEN source = 'youtube' THEN strftime(cts, '%Y-%m-%d %H:%M:%S') ELSE strftime(cts, '%Y-%m-%dT%H:%M:%S') END AS published_at
FROM v_conv_ts WHERE source IN ('youtube', 'reddit')"""

ORACLE["json_contents"] = f"""
WITH d AS (SELECT doc_id, lang, text, {_CSRC}[doc_id % 7 + 1] AS source, DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER) AS day,
                  doc_id % 13 = 0 AS blank FROM documents)
SELECT
  CASE WHEN doc_id % 11 <> 0 THEN CAST(doc_id AS VARCHAR)
       WHEN source = 'reddit' AND NOT blank THEN 'p' || CAST(doc_id AS VARCHAR)
       ELSE 'https://' || source || '.example/read/' || CAST(doc_id AS VARCHAR) END AS source_id,
  source,
  CASE WHEN blank THEN '' ELSE 'Post ' || CAST(doc_id AS VARCHAR) END AS title,
  CASE WHEN blank THEN '' WHEN source = 'youtube' THEN 'channel' || CAST(doc_id % 17 AS VARCHAR)
       ELSE 'user' || CAST(doc_id % 23 AS VARCHAR) END AS author,
  CASE WHEN blank OR source = 'reddit' THEN '' ELSE 'channel' || CAST(doc_id % 17 AS VARCHAR) END AS media,
  CASE WHEN blank THEN '' ELSE text END AS content,
  CASE WHEN doc_id % 3 <> 0 THEN strftime(day, '%Y-%m-%d %H:%M:%S')
       WHEN blank THEN ''
       WHEN source = 'youtube' THEN strftime(day, '%Y-%m-%d')
       ELSE strftime(CAST(day AS TIMESTAMP) + to_seconds(doc_id % 86400), '%Y-%m-%dT%H:%M:%S') END AS published_at
FROM d WHERE source IN ('youtube', 'reddit')"""

ORACLE["normalise_payload"] = """
WITH r AS (SELECT event_id AS ingest_seq, props AS raw FROM events
           UNION ALL SELECT -page_id - 1, html FROM pages),
o AS (SELECT ingest_seq, raw, coalesce(json_valid(raw), FALSE) AND json_type(CASE WHEN json_valid(raw) THEN raw ELSE '0' END) = 'OBJECT' AS ok FROM r)
SELECT ingest_seq, ok AS is_object,
  CASE WHEN ok THEN array_to_string(list_sort(json_keys(raw)), ',') ELSE '' END AS top_keys FROM o"""

def _unesc(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
            f"'&#39;', ''''), '&amp;', '&')")


ORACLE["extract_page_meta"] = """
WITH p AS (SELECT page_id, CAST(page_id AS VARCHAR) AS i, DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS day FROM pages)
SELECT page_id AS ingest_seq, CASE WHEN page_id % 4 = 0 THEN 'Page ' || i ELSE 'Story "' || i || '"' END AS title,
  CASE WHEN page_id % 3 = 0 THEN 'Writer ' || i ELSE 'Desk ' || i END AS author,
  strftime(day, '%Y-%m-%d') || CASE WHEN page_id % 5 = 0 THEN '' ELSE 'T03:00:00+07:00' END AS published_at,
  strftime(CASE WHEN page_id % 5 = 0 THEN CAST(day AS TIMESTAMP) ELSE CAST(day AS TIMESTAMP) - INTERVAL 4 HOUR END, '%Y-%m-%d %H:%M:%S') AS published_ts,
  i AS article_id, 'id' AS lang
FROM p"""

ORACLE["extract_cards"] = """
WITH p AS (SELECT page_id, CAST(page_id AS VARCHAR) AS i FROM pages)
SELECT page_id AS ingest_seq, CAST(0 AS BIGINT) AS pos, i || '0' AS content_id, 'https://host.example/news/read/' || i || '0/x' AS url,
  'Title ' || i || '0' AS title, 'news' AS category, '30 Januari 2024' AS date, '2024-01-30 00:00:00' AS published_ts FROM p
UNION ALL
SELECT page_id, 1, i || '1', 'https://s.example/sport/read/' || i || '1?a=1', 'Plain ' || i || '1 & more', 'sport', '2024-01-05 10:00', '2024-01-05 10:00:00' FROM p"""

ORACLE["url_parts"] = f"""{W('v_raw_pages')}
SELECT ingest_seq, url,
  regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
  regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS segment,
  nullif(regexp_extract(url, '/([0-9]+)(?:[/?#.]|$)', 1), '') AS article_id,
  CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) END AS page_param,
  CASE WHEN regexp_matches(url, '[?&]ref=') THEN regexp_extract(url, '[?&]ref=([^&#]*)', 1) END AS ref_param
FROM v_raw_pages"""

ORACLE["stable_ids"] = f"""{W('v_raw_pages')}
SELECT ingest_seq, md5(concat_ws(':', coalesce(source, ''), coalesce(content_id, ''))) AS row_id,
  sha256(url) AS url_sha256, sha1(url) AS url_sha1, md5(url) AS cache_key FROM v_raw_pages"""

ORACLE["json_path"] = """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '0') AS k FROM events"""

ORACLE["json_deep_find"] = """
SELECT 2097152 * conv_id + 1 AS ingest_seq, CASE WHEN turn = 0 THEN 1 ELSE 3 END AS depth,
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS value, turn = 0 AS first
FROM conversations WHERE conv_id % 5 < 2"""

ORACLE["extract_feed_entries"] = """
SELECT event_type AS keyword, CAST(event_id AS VARCHAR) AS content_id,
  'https://forum.example/r/' || event_type || '/comments/' || CAST(event_id AS VARCHAR) AS url,
  'Post ' || CAST(event_id AS VARCHAR) AS title, 'user' || CAST(user_id AS VARCHAR) AS author,
  'r/' || event_type AS media, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS published_at
FROM events WHERE event_id % 10 <> 0"""

ORACLE["extract_json_items"] = f"""{W('v_candidates')},
p AS (SELECT *, CAST(pos - (page - 1) * 20 AS INTEGER) AS ppos FROM v_candidates)
SELECT keyword, source, page, ppos AS pos, content_id AS item_id, 'https://cnn.example/read/' || content_id AS url,
  CAST(NULL AS VARCHAR) AS video_id FROM p WHERE source = 'cnn'
UNION ALL
SELECT keyword, source, page, ppos, CAST(NULL AS VARCHAR), '/watch?v=v' || content_id, 'v' || content_id
FROM p WHERE source <> 'cnn' AND CAST(content_id AS INTEGER) % 7 <> 0"""

ORACLE["normalise_timestamps"] = """
WITH t AS (SELECT event_id, ts, CAST(event_id % 9 AS INTEGER) AS k, date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS secs FROM events)
SELECT event_id,
  CASE k WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN 2 THEN CAST(day(ts) AS VARCHAR) || ' ' ||
           ['Januari','Februari','Maret','April','Mei','Juni','Juli','Agustus','September','Oktober','November','Desember'][month(ts)]
           || ' ' || CAST(year(ts) AS VARCHAR)
         WHEN 3 THEN CAST(secs AS VARCHAR)
         WHEN 4 THEN strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00'
         WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 6 THEN strftime(ts, '%Y-%m-%dT%H:%M')
         WHEN 7 THEN strftime(ts, '%Y-%m-%d') ELSE CAST(secs * 1000 AS VARCHAR) END AS published_at,
  strftime(CASE WHEN k IN (2, 7) THEN date_trunc('day', ts) WHEN k = 6 THEN date_trunc('minute', ts) ELSE ts END, '%Y-%m-%d %H:%M:%S') AS published_ts
FROM t"""

# ============================================================ sentiment, privacy

ORACLE["cascade_routing"] = f"""{W('v_opinions')}
SELECT source_id, source, CASE WHEN confidence < 0.75 THEN 'fallback' ELSE 'bulk' END AS engine,
  coalesce(confidence < 0.75, TRUE) AS needs_fallback FROM v_opinions"""

ORACLE["engine_report"] = f"""{W('v_opinions')},
r AS (SELECT confidence, CASE WHEN confidence < 0.75 THEN 'fallback' ELSE 'bulk' END AS engine FROM v_opinions WHERE ai_processed)
SELECT engine, count(*) AS n, round(avg(confidence), 6) AS avg_confidence,
  round(count_if(confidence < 0.75) / count(*), 6) AS share_low FROM r GROUP BY engine"""

ORACLE["apply_sentiment_updates"] = f"""{W('v_opinions')},
a AS (SELECT CASE CAST(user_id % 4 AS INTEGER) WHEN 0 THEN 'reddit' WHEN 1 THEN 'youtube' WHEN 2 THEN 'detik' ELSE 'cnn' END AS source,
        CAST(event_id AS VARCHAR) AS source_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
      FROM events WHERE event_id % 10 = 0),
l AS (SELECT source, source_id,
        CASE WHEN k < 34 THEN 'negative' WHEN k < 67 THEN 'neutral' ELSE 'positive' END AS sentiment,
        CASE WHEN k / CAST(100 AS DOUBLE) >= 0.75 THEN 'bulk' ELSE 'fallback' END AS engine,
        k / CAST(100 AS DOUBLE) AS confidence FROM a WHERE k % 9 <> 0)
SELECT o.source_id, o.source,
  CASE WHEN l.source IS NOT NULL THEN l.sentiment ELSE o.sentiment END AS sentiment,
  CASE WHEN l.source IS NOT NULL THEN l.engine END AS engine,
  round(CASE WHEN l.source IS NOT NULL THEN l.confidence ELSE o.confidence END, 6) AS confidence,
  CASE WHEN l.source IS NOT NULL THEN TRUE ELSE o.ai_processed END AS ai_processed
FROM v_opinions o LEFT JOIN l ON o.source = l.source AND o.source_id = l.source_id"""

# HMAC-SHA256(author, key) from sha256 over bytes; the padded keys are derived from the key by the
# standard construction (key XOR 0x36 / 0x5c, zero-padded to the 64-byte block).
ORACLE["pseudonymise_authors"] = f"""{W('v_opinions')}
SELECT source_id, source,
  sha256(unhex('31292e31292e712c2f39293833322531713739255c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c') || unhex(sha256(unhex('5b43445b43441b464553435259584f5b1b5d534f3636363636363636363636363636363636363636363636363636363636363636363636363636363636363636') || encode(author)))) AS author_hash
FROM v_opinions"""

# ============================================================ jobs

VIEWS["v_jobs"] = """
  SELECT job_id, keyword, coalesce(interval, '30d') AS interval, platforms, news_sources,
    coalesce(force, FALSE) AS force, CAST(coalesce("limit", 50) AS INTEGER) AS "limit" FROM (
    SELECT event_id AS job_id,
      CASE WHEN event_id % 50 = 0 THEN '   ' WHEN event_id % 50 = 1 THEN NULL ELSE event_type END AS keyword,
      ['30d', '7d', '1m', '2w', NULL][event_id % 5 + 1] AS interval,
      ['all', 'news', 'socmed'][user_id % 3 + 1] AS platforms,
      CASE WHEN user_id % 2 = 0 THEN 'all' ELSE 'detik,cnn' END AS news_sources,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 = 0 END AS force,
      CASE WHEN event_id % 13 = 0 THEN 0 WHEN event_id % 4 = 0 THEN 20 END AS "limit"
    FROM events) t
  WHERE trim(keyword) <> ''"""

ORACLE["valid_jobs"] = f"""{W('v_jobs')}
SELECT job_id, keyword, interval, platforms, news_sources, force, "limit" FROM v_jobs"""

ORACLE["job_source_fanout"] = f"""{W('v_jobs')},
s(name, kind) AS (VALUES ('detik', 'news'), ('cnn', 'news'), ('liputan6', 'news'), ('merdeka', 'news'),
                         ('youtube', 'socmed'), ('reddit', 'socmed'))
SELECT j.job_id, j.keyword, s.name AS source FROM v_jobs j, s
WHERE (j.platforms = 'all' OR j.platforms = s.kind)
  AND (s.kind <> 'news' OR j.news_sources = 'all' OR list_contains(string_split(j.news_sources, ','), s.name))"""

ORACLE["jobs_to_json"] = f"""{W('v_jobs')}
SELECT job_id, CAST(to_json({{'keyword': keyword, 'interval': interval, 'platforms': platforms,
  'news_sources': news_sources, 'force': force, 'limit': "limit"}}) AS VARCHAR) AS value FROM v_jobs"""

# ============================================================ streaming (same results as the batch twins)

ORACLE["stream_daily_sentiment"] = f"""{W('v_opinions')}
SELECT keyword, {_day()} AS day, sentiment, count(*) AS n FROM v_opinions GROUP BY keyword, day, sentiment"""
ORACLE["stream_ttl_dedupe"] = ORACLE["ttl_dedupe"]
ORACLE["stream_job_fanout"] = ORACLE["job_source_fanout"]
ORACLE["job_stream_decode"] = ORACLE["valid_jobs"]
ORACLE["stream_clean"] = ORACLE["run_totals"]

# ============================================================ warehouse to opinions, labels, keyword jobs

_BODY = "array_to_string([t FOR t IN [trim(regexp_replace(x, '\\s+', ' ', 'g')) FOR x IN string_split(d.text, chr(10))] IF t <> ''], chr(10))"
VIEWS["v_clean_full"] = f"""
  SELECT c.source, c.source_id, c.keyword, c.title, d.doc_id,
    CASE WHEN c.source IN ('youtube', 'reddit') AND c.doc_id % 13 = 0 THEN ''
         WHEN c.source = 'youtube' THEN 'channel' || CAST(c.doc_id % 17 AS VARCHAR) WHEN c.source = 'reddit' THEN 'user' || CAST(c.doc_id % 23 AS VARCHAR)
         WHEN c.source = 'detik' THEN 'Reporter ' || CAST(c.doc_id % 5 AS VARCHAR) ELSE 'Desk ' || CAST(c.doc_id % 9 AS VARCHAR) END AS author,
    CASE WHEN c.source IN ('youtube', 'reddit') THEN CASE WHEN c.doc_id % 13 = 0 THEN '' ELSE d.text END ELSE {_BODY} END AS content,
    CASE WHEN c.doc_id % 11 = 0 THEN '' ELSE CAST(c.doc_id AS VARCHAR) END AS content_id,
    CASE WHEN c.doc_id % 3 <> 0 THEN CAST(DATE '2024-01-01' + CAST(c.doc_id % 29 AS INTEGER) AS TIMESTAMP)
         WHEN c.doc_id % 13 = 0 OR c.source NOT IN ('youtube', 'reddit') THEN NULL
         WHEN c.source = 'youtube' THEN CAST(DATE '2024-01-01' + CAST(c.doc_id % 29 AS INTEGER) AS TIMESTAMP)
         ELSE CAST(DATE '2024-01-01' + CAST(c.doc_id % 29 AS INTEGER) AS TIMESTAMP) + to_seconds(c.doc_id % 86400) END AS pts
  FROM v_clean_contents c JOIN documents d ON d.doc_id = c.doc_id"""


def _hmac(c: str) -> str:
    """HMAC-SHA256 of a text in hex, from sha256 over blobs."""
    k = SECRET.encode().ljust(64, b"\0")
    blob = lambda pad: "'" + "".join(f"\\x{b ^ pad:02X}" for b in k) + "'::BLOB"
    return f"sha256({blob(0x5C)} || unhex(sha256({blob(0x36)} || encode({c}))))"


_CID = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"
ORACLE["clean_contents"] = f"""{W('v_clean_contents', 'v_clean_full')}
SELECT source, source_id, keyword, title, {_hmac('author')} AS author_hash, md5(content) AS body_md5, {_ts('pts')} AS published_ts FROM v_clean_full"""
ORACLE["source_registry_union"] = ORACLE["clean_contents"]
ORACLE["clean_comments"] = f"""{W('v_conv_ts')}
SELECT source, {_CID} AS source_id, CAST(conv_id AS VARCHAR) AS content_id, CAST(2 * conv_id AS VARCHAR) AS raw_parent_id,
  {_hmac('role')} AS author_hash, md5(text) AS body_md5, {_ts('cts')} AS published_ts FROM v_conv_ts WHERE source <> 'kompas'"""
ORACLE["stream_clean"] = f"""{W('v_clean_contents', 'v_clean_full', 'v_conv_ts')}
SELECT 'contents' AS table_name, source, source_id, keyword, {_hmac('author')} AS author_hash, md5(content) AS body_md5, {_ts('pts')} AS published_ts FROM v_clean_full
UNION ALL
SELECT 'comments', source, {_CID}, 'thread', {_hmac('role')}, md5(text), {_ts('cts')} FROM v_conv_ts WHERE source <> 'kompas'"""
ORACLE["opinions_view"] = f"""{W('v_clean_contents', 'v_clean_full', 'v_conv_ts')}
SELECT source, {_CID} AS source_id, 'comment' AS kind, 'thread' AS keyword, CAST(conv_id AS VARCHAR) AS content_id, md5(text) AS body_md5, {_ts('cts')} AS published_ts
FROM v_conv_ts WHERE source <> 'kompas'
UNION ALL
SELECT source, source_id, 'post', keyword, content_id, md5(content), {_ts('pts')} FROM v_clean_full WHERE source = 'reddit'"""
ORACLE["comments_with_parent"] = f"""{W('v_clean_contents', 'v_clean_full', 'v_conv_ts')}
SELECT m.source, {_CID} AS source_id, CAST(m.conv_id AS VARCHAR) AS content_id, c.source AS parent_source,
  CASE WHEN c.doc_id IS NOT NULL THEN 'https://' || c.source || '.example/read/' || CAST(c.doc_id AS VARCHAR) END AS parent_url, c.keyword AS parent_keyword
FROM v_conv_ts m LEFT JOIN v_clean_full c ON c.doc_id = m.conv_id WHERE m.source <> 'kompas'"""
ORACLE["label_pass"] = f"""{W('v_conv_ts')},
c AS (SELECT source, {_CID} AS source_id, length(text) AS n FROM v_conv_ts WHERE source <> 'kompas')
SELECT source, source_id, CASE n % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' END AS sentiment,
  CASE WHEN n % 4 < 3 THEN CASE WHEN (n % 100) / 100.0 < 0.75 THEN 'fallback' ELSE 'bulk' END END AS engine,
  CASE WHEN n % 4 < 3 THEN round((n % 100) / CAST(100 AS DOUBLE), 6) END AS confidence, n % 4 < 3 AS ai_processed
FROM c"""
ORACLE["extract_articles"] = f"""{W('v_clean_contents', 'v_clean_full')}
SELECT source_id, source, title, author, content, CASE WHEN doc_id % 3 = 0 THEN '' ELSE {_ts('pts')} END AS published_at
FROM v_clean_full WHERE source NOT IN ('youtube', 'reddit')"""
ORACLE["json_dir_to_messages"] = """
WITH m AS (SELECT event_id, {fields} AS fields FROM (
    SELECT event_id,
      CASE WHEN event_id % 50 = 0 THEN '   ' WHEN event_id % 50 = 1 THEN NULL ELSE event_type END AS keyword,
      ['30d', '7d', '1m', '2w', NULL][event_id % 5 + 1] AS interval, ['all', 'news', 'socmed'][user_id % 3 + 1] AS platforms,
      CASE WHEN user_id % 2 = 0 THEN 'all' ELSE 'detik,cnn' END AS news_sources,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 = 0 END AS force,
      CASE WHEN event_id % 13 = 0 THEN 0 WHEN event_id % 4 = 0 THEN 20 END AS "limit" FROM events) t)
SELECT '[' || string_agg('{{' || array_to_string([f FOR f IN fields IF f IS NOT NULL], ',') || '}}', ',' ORDER BY event_id) || ']' AS value
FROM m GROUP BY event_id // 100""".format(fields="[" + ", ".join(
    f"""'"{c}":' || CAST(to_json({'"limit"' if c == 'limit' else c}) AS VARCHAR)""" for c in ("force", "interval", "keyword", "limit", "news_sources", "platforms")) + "]")

ORACLE["job_candidates"] = f"""{W('v_candidates', 'v_jobs')},
r AS (SELECT *, row_number() OVER (PARTITION BY keyword, source, content_id ORDER BY pos) AS rn FROM v_candidates),
p AS (SELECT keyword, source, page, sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS n_new FROM r GROUP BY keyword, source, page),
s AS (SELECT keyword, source, coalesce(min(CASE WHEN n_new = 0 THEN page END), 51) AS stop_page FROM p WHERE page <= 50 GROUP BY keyword, source),
l AS (SELECT r.keyword, r.source, content_id, pos, row_number() OVER w AS rank, min(published_ts) OVER (w ROWS UNBOUNDED PRECEDING) AS oldest
      FROM r JOIN s USING (keyword, source) WHERE rn = 1 AND page < stop_page AND page <= 50 WINDOW w AS (PARTITION BY r.keyword, r.source ORDER BY pos)),
j AS (SELECT job_id, keyword, s.name AS source, force, "limit", TIMESTAMP '2024-01-30 00:00:00' - CASE interval
        WHEN '30d' THEN INTERVAL 30 DAY WHEN '7d' THEN INTERVAL 7 DAY WHEN '1m' THEN INTERVAL 1 MONTH WHEN '2w' THEN INTERVAL 14 DAY END AS cutoff
      FROM v_jobs, (VALUES ('cnn'), ('liputan6')) s(name)
      WHERE platforms IN ('all', 'news') AND (news_sources = 'all' OR list_contains(string_split(news_sources, ','), s.name))),
live AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS content_id FROM events WHERE user_id % 6 = 0)
SELECT job_id, j.source, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos, CAST(max(rank) AS BIGINT) AS last_rank
FROM j JOIN l ON l.keyword = j.keyword AND l.source = j.source AND ("limit" = 0 OR rank <= "limit") AND (oldest IS NULL OR oldest >= cutoff)
WHERE force OR l.content_id NOT IN (SELECT content_id FROM live)
GROUP BY job_id, j.source"""
