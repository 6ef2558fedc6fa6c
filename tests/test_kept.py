"""Kept daily aggregates: equal to the scans, unchanged by a replay, right after relabelling and deletes."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from murmur import fixtures as fx
from murmur.operators import analytics as an
from murmur.operators import kept as kp
from tests.conftest import SF_SMALL

TODAY = datetime(2024, 1, 30)


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_reports_equal_the_scans(spark, tmp_path):
    op = fx.opinions(spark, SF_SMALL)
    kp.keep(op, str(tmp_path / "k"))
    k = kp.kept(spark, str(tmp_path / "k"))
    for got, want in ((kp.headline(k, "7d", TODAY), an.sentiment_headline(op, "7d", TODAY)), (kp.distribution(k), an.sentiment_distribution(op)),
                      (kp.daily(k), an.keyword_sentiment_daily(op)), (kp.compare(k), an.compare_keywords(op)), (kp.rollup(k), an.opinion_rollup(op))):
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want) != []
    exact = {r.source: r for r in op.groupBy("source").agg(F.count_distinct("source_id").alias("o"), F.count_distinct("content_id").alias("c")).collect()}
    for r in kp.serving(k, "source").collect():
        assert abs(r.opinions - exact[r.source].o) <= 0.05 * exact[r.source].o
        assert abs(r.contents - exact[r.source].c) <= 0.05 * exact[r.source].c + 1
    with pytest.raises(ValueError):
        kp.headline(k, "24h", TODAY)


def test_days_are_replaced_alone(spark, tmp_path):
    base = str(tmp_path / "k")
    op = fx.opinions(spark, SF_SMALL)
    kp.keep(op, base)
    before = rows(kp.kept(spark, base).drop("ids", "contents"))
    kept_files = set(map(str, (tmp_path / "k").glob("day=2024-01-05/*.parquet")))
    kp.keep(op, base, [date(2024, 1, 9), date(2024, 1, 10)])
    assert rows(kp.kept(spark, base).drop("ids", "contents")) == before            # a replay
    changed = op.where("day <> DATE '2024-01-10'").withColumn("sentiment", F.when(F.col("day") == F.lit(date(2024, 1, 9)), "neutral").otherwise(F.col("sentiment")))
    kp.keep(changed, base, [date(2024, 1, 9), date(2024, 1, 10)])                  # relabelled, deleted
    k = kp.kept(spark, base)
    assert rows(kp.daily(k)) == rows(an.keyword_sentiment_daily(changed))
    assert k.where("day = DATE '2024-01-10'").count() == 0
    assert kept_files and kept_files == set(map(str, (tmp_path / "k").glob("day=2024-01-05/*.parquet")))


def test_nulls_and_nothing(spark, tmp_path):
    schema = "source_id string, source string, keyword string, content_id string, sentiment string, confidence double, day date"
    assert kp.kept(spark, str(tmp_path / "none")).count() == 0
    op = spark.createDataFrame([("1", None, None, None, None, None, None), ("2", "s", "k", "c", "positive", 0.5, date(2024, 1, 1)),
                                (None, "s", "k", "c", "positive", None, date(2024, 1, 1))], schema)
    kp.keep(op, str(tmp_path / "k"))
    got = {(r.day, r.keyword): (r.n, r.avg_confidence, r.opinions) for r in kp.serving(kp.kept(spark, str(tmp_path / "k")), "day", "keyword").collect()}
    assert got == {(None, None): (1, None, 1), (date(2024, 1, 1), "k"): (2, 0.5, 1)}
    kp.keep(op.limit(0), str(tmp_path / "e"))
    assert kp.kept(spark, str(tmp_path / "e")).count() == 0


def test_serving_prunes_days(spark, tmp_path):
    kp.keep(fx.opinions(spark, SF_SMALL), str(tmp_path / "k"))
    q = kp.serving(kp.kept(spark, str(tmp_path / "k")), "source", since=date(2024, 1, 3), until=date(2024, 1, 4), keyword="click")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in p and "EqualTo(keyword,click)" in p
