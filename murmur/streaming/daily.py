"""Streaming daily counts per keyword x sentiment (the live form of the daily snapshot).

Each micro-batch aggregates its own rows into one-day tumbling windows (`window(ts, '1 day')`,
partial aggregation map-side) and appends the counts as a delta under its `batch_id` (overwritten
when a batch is replayed, so each batch counts once). The snapshot is the sum of the deltas per
(keyword, day, sentiment). No streaming state is kept, so a row that arrives late - even after its
day would have been closed by a watermark - is still added to its own day, never dropped and never
allowed to restart a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import fixtures as fx
from murmur.streaming.common import new_location, ntz_as_instant, run_available, table_stream, write_batch

KEYS = ["keyword", "day", "sentiment"]


def daily_deltas(events_batch: DataFrame) -> DataFrame:
    """One micro-batch -> counts per (keyword, UTC day, sentiment) via a one-day tumbling window."""
    op = fx.opinions_from_events(events_batch).withColumn("ts", ntz_as_instant(F.col("published_ts")))
    agg = op.groupBy(F.window("ts", "1 day").alias("w"), "keyword", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    day = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                           F.col("w.start").cast("timestamp_ntz")), "yyyy-MM-dd")
    return agg.select("keyword", day.alias("day"), "sentiment", "n")


def snapshot(spark: SparkSession, deltas_path: str) -> DataFrame:
    return spark.read.parquet(deltas_path).groupBy(*KEYS).agg(F.sum("n").alias("n"))


def run_daily_sentiment(spark: SparkSession, sf_dir: str, events: DataFrame | None = None,
                        out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    out = out or new_location(spark, "tables", "daily_sentiment")
    stream = events if events is not None else table_stream(spark, sf_dir, "events")
    run_available(stream, lambda b, i: write_batch(daily_deltas(b), out, i), "daily_sentiment",
                  checkpoint=checkpoint)
    return snapshot(spark, out)
