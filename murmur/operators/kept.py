"""Kept daily aggregates from which the reports are answered without a scan of the opinions.

One row per (day, keyword, source, sentiment): the number of opinions, of those with a confidence, the sum of
the confidences (decimal, so that it does not depend on the order of merging) and HLL sketches of the
opinions' and contents' ids. Counts add and sketches merge, so any set of dimensions over any days is
answered from these rows; distinct counts have a standard error of 1.04 / sqrt(2^LG_K), 1.6 per cent.

The table is partitioned by day. `keep` works out whole days from the opinions and replaces just these
days (dynamic partition overwrite), so keeping a day again, after late or relabelled rows or after a lost
job, leaves what one pass over the opinions would have made. Days are passed by name; rows never are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.functions.times import in_window
from murmur.operators.analytics import SENTIMENTS, _share
from murmur.operators.warehouse import _missing

LG_K = 12
DIMS = ("day", "keyword", "source", "sentiment")
SCHEMA = ("keyword string, source string, sentiment string, n long, n_confidence long, sum_confidence decimal(38,10), "
          "ids binary, contents binary, day date")


def keep(op: DataFrame, base: str, days: Iterable[date] | None = None) -> None:
    """Work out the days of `op` (or just `days`) and put them in the place of what `base` holds of them. `op` must
    hold all opinions of these days. Of `days`, one without opinions is emptied. A null day is a day of its
    own (kept only without `days`); null keywords, sources and labels count as such."""
    days = None if days is None else sorted(set(days))
    rows = op if days is None else op.where(F.col("day").isin(days))
    agg = rows.groupBy(*DIMS).agg(
        F.count(F.lit(1)).alias("n"), F.count("confidence").alias("n_confidence"),
        F.sum(F.col("confidence").cast("decimal(20,10)")).cast("decimal(38,10)").alias("sum_confidence"),
        F.hll_sketch_agg("source_id", LG_K).alias("ids"), F.hll_sketch_agg("content_id", LG_K).alias("contents"))
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    agg = agg.select(*columns)
    if days:
        empty = op.sparkSession.createDataFrame([(d,) for d in days], "day date").withColumn("n", F.lit(0).cast("long"))
        agg = agg.unionByName(empty, allowMissingColumns=True).select(*columns)
    (agg.repartition("day", "keyword").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(base))


def kept(spark: SparkSession, base: str) -> DataFrame:
    """The aggregates of all days kept so far (none: empty)."""
    try:
        return spark.read.schema(SCHEMA).parquet(base).where("n > 0")
    except AnalysisException as ex:
        if not _missing(ex):
            raise
        return spark.createDataFrame([], SCHEMA)


def _n(where: Column | None = None) -> Column:
    return F.coalesce(F.sum("n" if where is None else F.when(where, F.col("n"))), F.lit(0))


def serving(rows: DataFrame, *by: str, keyword: str | None = None, source: str | None = None, sentiment: str | None = None,
            since: date | None = None, until: date | None = None) -> DataFrame:
    """Counts, mean confidence and distinct opinions and contents (estimates) by the dimensions `by`, of the days
    `since` to `until` (both included) and the given keyword, source and label. Days prune folders."""
    for name, value in (("keyword", keyword), ("source", source), ("sentiment", sentiment)):
        rows = rows if value is None else rows.where(F.col(name) == value)
    rows = rows if since is None else rows.where(F.col("day") >= F.lit(since))
    rows = rows if until is None else rows.where(F.col("day") <= F.lit(until))
    mean = _share(F.sum("sum_confidence").cast("double"), F.sum("n_confidence"))
    return rows.groupBy(*by).agg(
        _n().alias("n"), F.round(mean, 6).alias("avg_confidence"),
        F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("opinions"), F.hll_sketch_estimate(F.hll_union_agg("contents")).alias("contents"))


def headline(rows: DataFrame, window: str = "30d", today: datetime | None = None) -> DataFrame:
    """E2 from kept days: such windows begin and end at midnight. Hour windows do not and are an error."""
    if re.search(r"\d\s*h\s*$", window, re.I):
        raise ValueError("windows of hours need the opinions: analytics.sentiment_headline")
    days = rows.withColumn("_at", F.col("day").cast("timestamp_ntz")).where(in_window("_at", window, today or datetime.now()))
    agg = days.groupBy("keyword").agg(_n().alias("total"), *[_n(F.col("sentiment") == s).alias(f"n_{s}") for s in SENTIMENTS])
    return agg.select("keyword", "total", *[F.round(_share(F.col(f"n_{s}"), F.col("total")), 6).alias(f"pct_{s}") for s in SENTIMENTS])


def distribution(rows: DataFrame) -> DataFrame:
    """E3 from kept days."""
    agg = rows.groupBy("keyword", "sentiment").agg(_n().alias("n"))
    return agg.select("keyword", "sentiment", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("keyword")), 6).alias("share"))


def daily(rows: DataFrame) -> DataFrame:
    """E4 from kept days."""
    return serving(rows, "keyword", "day", "sentiment").drop("opinions", "contents")


def compare(rows: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """E9 from kept days."""
    rows = rows if not keywords else rows.where(F.col("keyword").isin(keywords))
    agg = rows.groupBy("keyword").agg(*[_n(F.col("sentiment") == s).alias(s) for s in SENTIMENTS])
    total = sum((F.col(s) for s in SENTIMENTS), F.lit(0))
    return agg.select("keyword", *SENTIMENTS, total.alias("total"), *[F.round(_share(F.col(s), total), 6).alias(f"share_{s}") for s in SENTIMENTS])


def rollup(rows: DataFrame) -> DataFrame:
    """E12 from kept days."""
    return rows.rollup("keyword", "source").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
