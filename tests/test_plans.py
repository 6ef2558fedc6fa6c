"""
pruned, per-group top-k is limited map-side; stream replays are idempotent."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from murmur.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "PythonUDF")
# Python workers are expected only where HTML text or JSON without depth bound needs them (C2, C17), and in streams.
PYTHON_OK = {"extract_articles", "source_registry_union", "clean_contents", "comments_with_parent", "opinions_view", "run_totals", "json_deep_find"}
RUNS_STREAM = {k for k in QUERIES if k.startswith("stream_")} | {"job_stream_decode", "json_dir_to_messages",
                                                                        "ttl_dedupe"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - PYTHON_OK - RUNS_STREAM))
def test_no_python_in_native_plans(spark, key):
    p = plan(entry.queries()[key](spark, SF_SMALL))
    assert not any(n in p for n in PYTHON_NODES), p


def test_incremental_scan_pushes_checkpoint(spark):
    p = plan(entry.queries()["raw_incremental_scan"](spark, SF_SMALL))
    assert "GreaterThan(page_id,100)" in p


def test_opinion_filter_pushdown(spark):
    p = plan(entry.queries()["opinions_filter"](spark, SF_SMALL))
    assert "EqualTo(event_type,view)" in p
    assert "GreaterThanOrEqual(ts," in p


def test_column_pruning(spark):
    p = plan(entry.queries()["keyword_sentiment_daily"](spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert scan and all("props" not in line for line in scan)


@pytest.mark.parametrize("key", ["limit_per_job", "top_words_by_sentiment"])
def test_topk_limited_map_side(spark, key):
    p = plan(entry.queries()[key](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_python_stage_after_filter(spark):
    """The HTML stage receives only news rows: the source filter sits below MapInPandas."""
    p = plan(entry.queries()["extract_articles"](spark, SF_SMALL))
    assert "MapInPandas" in p
    below = p[p.index("MapInPandas"):]
    assert "Filter" in below


def test_stream_clean_replay_is_idempotent(spark):
    from murmur import fixtures as fx
    from murmur.operators import warehouse as wh
    from murmur.streaming.clean import run_clean
    from murmur.streaming.common import new_location
    raw = new_location(spark, "raw", "t")
    wh.append_raw(fx.raw_documents(spark, SF_SMALL), raw)
    base = new_location(spark, "warehouse", "t")
    paths = run_clean(spark, raw, base)
    count = lambda: [spark.read.parquet(paths[t]).count() for t in ("contents", "comments", "rejects")]
    n1 = count()
    run_clean(spark, raw, base)                     # a new checkpoint replays every file
    assert n1 == count() and min(n1) > 0
    assert spark.read.parquet(paths["contents"]).where("author IS NOT NULL").count() == 0   # no key, no author


def test_inserts_aggregate_keys_only(spark):
    """No body is sorted or kept in an aggregate on the way into the warehouse (repeats of a row aside)."""
    from murmur.operators import warehouse as wh
    from murmur.sources.tables import read_table
    docs = read_table(spark, SF_SMALL, "documents").selectExpr("source", "cast(doc_id as string) AS source_id", "text AS content", "doc_id AS raw_id")
    _, first = wh._ranked(docs, wh.WAREHOUSE_KEYS, "raw_id")
    assert "content" not in "".join(line for line in plan(first).splitlines() if "Aggregate" in line and "Results" in line)
    again = docs.union(docs).union(docs.withColumn("raw_id", docs.raw_id + 1))
    assert wh.new_rows(again, docs.where("raw_id % 2 = 0")).count() == docs.where("raw_id % 2 = 1").count()


def test_articles_are_parsed_only_for_new_keys(spark):
    from murmur import fixtures as fx
    from murmur.operators import cleaner as cl
    raw = fx.raw_documents(spark, SF_SMALL)
    contents, _, _ = cl.clean(raw)
    known = contents.select("source", "source_id")
    left = cl.fresh(raw.union(raw), known)
    assert left.where("type = 'content' AND source IN ('detik', 'cnn', 'liputan6', 'merdeka') AND raw <> ''").count() == 0
    later = raw.withColumn("ingest_seq", raw.ingest_seq + 10**9)     # the same articles found again
    assert cl.fresh(raw.union(later), known.limit(0)).where("type = 'content' AND source = 'cnn'").count() == raw.where("type = 'content' AND source = 'cnn'").count()


def _parts(spark, path, *frames):
    for k, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(path)


def test_streams_over_directory_tables_equal_their_oracle(spark, duck, tmp_path):
    """A table of several part files, read in several micro-batches, whatever the files' order."""
    from murmur.plans.verify import compare
    from murmur.sources.tables import read_table
    ev = read_table(spark, SF_SMALL, "events")
    _parts(spark, str(tmp_path / "events.parquet"), *[ev.where(f"event_id % 3 = {k}") for k in (2, 0, 1)])
    for key in ("stream_ttl_dedupe", "stream_daily_sentiment"):
        df = entry.queries()[key](spark, str(tmp_path))
        res = duck.execute(entry.oracle_sql()[key])
        ok, msg = compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in res.description], res.fetchall())
        assert ok, (key, msg)


def test_ttl_stream_out_of_order_and_late(spark, tmp_path):
    """Files out of time order give what the batch form gives; a row behind the watermark is reconciled."""
    import time
    from datetime import datetime

    from murmur.operators import candidates as cd
    from murmur.streaming.common import read_batches
    from murmur.streaming.dedupe import JUDGED, run_ttl_dedupe
    schema = "user_id long, event_id long, ts timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    files = [[(1, 1, day(1)), (2, 2, day(12))], [(1, 3, day(4))], [(1, 4, day(9)), (2, 5, day(13))]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"f{k}"))
        time.sleep(1.1)

    def run(lateness, out):
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(*[str(tmp_path / "f[0-9]")])
        return sorted(r.event_id for r in run_ttl_dedupe(spark, "", 7, events=src, lateness_days=lateness, out=out).collect())
    rows = spark.createDataFrame(sum(files, []), schema)
    judged = lambda out: sorted((r.event_id, r.accepted) for r in read_batches(spark, str(tmp_path / out), JUDGED).collect())
    assert run(31, str(tmp_path / "a")) == sorted(r.event_id for r in cd.ttl_dedupe(rows, "user_id", "ts", 7, "event_id").collect()) == [1, 2, 4]
    assert judged("a") == []                         # the watermark passes nothing: all is judged at the end
    assert run(2, str(tmp_path / "b")) == [1, 2, 4]  # day 9 comes behind the watermark and is reconciled
    assert judged("b") == [(1, True), (3, False)]


def test_ttl_stream_judges_most_events_in_micro_batches(spark, tmp_path):
    """The registered query: most events are judged by the stream, with the decisions of the batch form."""
    from murmur.sources.tables import read_table
    from murmur.streaming.common import read_batches
    from murmur.streaming.dedupe import JUDGED, run_ttl_dedupe
    out = str(tmp_path / "judged")
    got = {r.event_id for r in run_ttl_dedupe(spark, SF_SMALL, 7, out=out).collect()}
    judged = read_batches(spark, out, JUDGED).collect()
    n = read_table(spark, SF_SMALL, "events").count()
    assert n * 0.7 < len(judged) < n and len({r.event_id for r in judged}) == len(judged)
    assert {r.event_id for r in judged if r.accepted} <= got
    assert not {r.event_id for r in judged if not r.accepted} & got


def test_ttl_reconcile_bags_null_keys_and_late_rows(spark):
    """Rows without a key, repeated rows and rows between judged ones are judged from the archive."""
    from datetime import datetime

    from murmur.streaming.dedupe import reconcile
    day = lambda d: datetime(2024, 1, d)
    archive = spark.createDataFrame([(1, 1, day(1), False), (1, 2, day(5), False), (1, 3, day(9), False), (1, 9, day(20), False), (None, 4, day(1), False),
                                     (None, 5, day(3), False), (2, 6, day(2), True), (2, 6, day(2), True), (2, 7, None, False)],
                                    "user_id long, event_id long, ts timestamp_ntz, force boolean")
    judged = spark.createDataFrame([(1, 1, day(1), True), (1, 3, day(9), True), (2, 6, day(2), True)],
                                   "user_id long, event_id long, ts timestamp_ntz, accepted boolean")
    rows = lambda df, ttl: sorted((r.user_id or 0, r.event_id) for r in reconcile(archive, df, ttl).collect())
    assert rows(judged, 4) == rows(judged.limit(0), 4) == [(0, 4), (1, 1), (1, 2), (1, 3), (1, 9), (2, 6), (2, 6)]
    assert rows(judged, 7) == rows(judged.limit(0), 7) == [(0, 4), (1, 1), (1, 3), (1, 9), (2, 6), (2, 6)]


def test_ttl_pointer_jumping_rounds(spark):
    """A TTL of an hour over a month takes at most twelve rounds, hot key and forced events included."""
    import random
    from datetime import datetime, timedelta

    from murmur.operators.ttl import ttl_chain
    from tests.test_properties import greedy
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    events = [(t0 + timedelta(seconds=rnd.randrange(0, 30 * 86400, 600)), i, rnd.choice([None, 1, 1, 2]), rnd.random() < 0.002) for i in range(4000)]
    df = spark.createDataFrame(events, "ts timestamp_ntz, id long, k long, f boolean")
    out, rounds = ttl_chain(df.withColumn("key", F.lit("x")).withColumn("block", F.lit(1)), "k", "ts", 1 / 24, "id", "f")
    assert sorted(r.id for r in out.collect()) == greedy(events, timedelta(hours=1)) and rounds <= 12
    assert out.columns == ["k", "ts", "id"]
    assert ttl_chain(df.limit(0), "k", "ts", 1, "id", "f")[0].count() == 0
    with pytest.raises(ValueError):
        ttl_chain(df, "k", "ts", 0, "id")


def test_jobs_meet_reduced_lists(spark):
    """The keyword-job path joins jobs only to ranked lists, with the job rules in the join."""
    p = plan(entry.queries()["job_candidates"](spark, SF_SMALL))
    join = next(line for line in p.splitlines() if "Join" in line and "oldest" in line)
    assert "rank" in join and "cutoff" in join


def test_shares_sum_to_one(spark):
    from pyspark.sql import functions as F
    df = entry.queries()["sentiment_distribution"](spark, SF_SMALL)
    sums = df.groupBy("keyword").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-5 for r in sums)


def test_ttl_accepted_are_ttl_apart_unless_forced(spark):
    from pyspark.sql import Window, functions as F
    df = entry.queries()["ttl_dedupe"](spark, SF_SMALL)
    w = Window.partitionBy("user_id").orderBy("accepted_at", "event_id")
    ts = F.to_timestamp("accepted_at")
    gaps = df.select((F.unix_seconds(ts) - F.unix_seconds(F.lag(ts).over(w))).alias("g"),
                     (F.col("event_id") % 37 == 0).alias("forced"))
    assert gaps.where(f"g IS NOT NULL AND g < {7 * 86400} AND NOT forced").count() == 0
    assert gaps.where("forced").count() > 0


def test_stream_daily_counts_late_rows_exactly(spark, tmp_path):
    """J4/J5 (stream): a later micro-batch of rows for an older day is added to that day, and a
    resumed query does not count a batch twice."""
    import time
    from datetime import datetime

    from murmur.streaming.daily import run_daily_sentiment

    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    src = tmp_path / "events"
    day10 = [(i, datetime(2024, 1, 10, 12), i, "view", 50.0, "{}") for i in range(5)]
    day5a = [(50 + i, datetime(2024, 1, 5, 12), i, "view", 50.0, "{}") for i in range(2)]
    day5b = [(100 + i, datetime(2024, 1, 5, 13), i, "view", 50.0, "{}") for i in range(3)]
    for name, rows in (("b1", day5a), ("b2", day10), ("b3", day5b)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / name))
        time.sleep(1.1)

    def stream():
        return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", True).parquet(str(src)))

    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    res = run_daily_sentiment(spark, "", events=stream(), out=out, checkpoint=ckpt)
    assert {(r.day, r.n) for r in res.collect()} == {("2024-01-05", 5), ("2024-01-10", 5)}
    res = run_daily_sentiment(spark, "", events=stream(), out=out, checkpoint=ckpt)   # resume: nothing new
    assert {(r.day, r.n) for r in res.collect()} == {("2024-01-05", 5), ("2024-01-10", 5)}


@pytest.mark.parametrize("key", ["normalise_timestamps", "flat_comments", "stream_daily_sentiment", "ttl_dedupe",
                                 "trending_keywords"])
def test_results_do_not_depend_on_session_zone(spark, duck, key):
    from murmur.plans.verify import compare
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        df = entry.queries()[key](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(entry.oracle_sql()[key])
    ok, msg = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert ok, msg


def test_stream_ttl_carries_state_across_batches(spark, tmp_path):
    """A stream fed in three time-ordered micro-batches accepts exactly what the batch operator
    accepts on all rows at once (thresholds carried between batches, forced events included)."""
    import time
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from murmur.operators.candidates import ttl_dedupe
    from murmur.streaming.dedupe import run_ttl_dedupe

    schema = "event_id long, ts timestamp_ntz, user_id long"
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0 + timedelta(hours=13 * i), i % 3) for i in range(60)]      # ~32 days, 3 keys
    src = tmp_path / "events"
    for n, part in enumerate((rows[:20], rows[20:40], rows[40:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(src / f"b{n}"))
        time.sleep(1.1)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(str(src)))
    force = F.col("event_id") % 11 == 0
    got = {(r.user_id, r.event_id) for r in run_ttl_dedupe(spark, "", 3, force=force, events=stream).collect()}
    whole = spark.createDataFrame(rows, schema).withColumn("f", force)
    want = {(r.user_id, r.event_id) for r in ttl_dedupe(whole, "user_id", "ts", 3, "event_id", "f").collect()}
    assert got == want and len(want) > 10


def test_ttl_stream_judges_an_arrival_in_one_batch(spark, tmp_path, monkeypatch):
    """A table of several files: each arrival is one micro-batch (and one that moves the watermark), so no row comes
    behind the watermark, and the stream judges all it has passed. Keys share a bucket, whose state takes many values."""
    from datetime import datetime, timedelta

    from murmur.operators.candidates import ttl_dedupe
    from murmur.streaming import dedupe as D
    from murmur.streaming.common import read_batches
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0 + timedelta(minutes=61 * i), i % 7) for i in range(700)] + [(700, t0, None), (None, t0, 3), (701, None, 3)]
    whole = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")
    _parts(spark, str(tmp_path / "events.parquet"), *[whole.where(f"coalesce(event_id, 0) % 4 = {k}") for k in range(4)])
    monkeypatch.setattr(D, "BUCKETS", 2, raising=False)
    monkeypatch.setattr(D, "CHUNK", 3, raising=False)  # as arrays of more than 100 values take another way to the state
    out, force = str(tmp_path / "out"), F.col("event_id") % 11 == 0
    got = sorted((r.user_id or -1, r.event_id or -1) for r in D.run_ttl_dedupe(spark, str(tmp_path), 3, force=force, out=out).collect())
    want = ttl_dedupe(whole.withColumn("f", force), "user_id", "ts", 3, "event_id", "f").collect()
    assert got == sorted((r.user_id or -1, r.event_id or -1) for r in want)
    assert len(list((tmp_path / "out").glob("batch_id=*"))) <= 6
    passed = t0 + timedelta(minutes=61 * 699) - timedelta(days=5)
    assert {r.event_id for r in read_batches(spark, out, D.JUDGED).collect()} == {i for i, ts, user in rows if None not in (i, ts, user) and ts <= passed}


def test_python_stages_run_outside_the_repo(tmp_path):
    """Workers must not need the package on their path: run the Python-stage keys from another
    directory in a plain session (as a driver would) in a separate process."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "for k in ('extract_articles', 'classify_cascade'):\n"
        "    assert e.queries()[k](s, %r).count() > 0, k\n"
        "print('PY-STAGES-OK')\n" % (root, SF_SMALL))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "PY-STAGES-OK" in out.stdout, out.stderr[-2000:]
