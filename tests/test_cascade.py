"""The trained cascade on held-out labelled rows, its calibration, and rows without texts."""

import pytest
from pyspark.sql import functions as F

from murmur import fixtures as fx
from murmur.operators import cascade as ca
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def fitted(spark):
    rows = fx.labelled(spark, SF_MID)
    held = ca.text_part("content", 5, "held") == 0
    return ca.train_cascade(rows.where(~held)), rows.where(held)


def test_held_out_quality(fitted):
    model, held = fitted
    q = {r.view: r for r in ca.cascade_quality(model, held).collect()}
    n = held.count()
    common = held.groupBy("sentiment").count().agg(F.max("count")).first()[0] / n
    assert q["cascade"].n == q["bulk"].n == n and 0 < q["fallback"].n < n
    assert q["bulk"].calibration_error < q["bulk_raw"].calibration_error / 2
    assert q["cascade"].calibration_error < 0.12 and q["fallback"].calibration_error < 0.25
    assert q["cascade"].accuracy > q["bulk"].accuracy
    assert q["cascade"].accuracy > common


def test_rows_without_text_and_clashing_columns(spark, fitted):
    model, _ = fitted
    rows = spark.createDataFrame([(1, None, "old", 5), (2, "", "old", 6), (3, "a plain text " * 3, None, 7)],
                                 "id int, content string, sentiment string, low int")
    out = {r.id: r for r in ca.classify(model, rows).collect()}
    assert (out[1].sentiment, out[1].engine, out[1].confidence) == (None, None, None)
    assert all(out[i].sentiment in ("positive", "negative", "neutral") and 0 <= out[i].confidence <= 1 for i in (2, 3))
    assert [out[i].low for i in (1, 2, 3)] == [5, 6, 7]
    assert all((out[i].engine == "bulk") == (out[i].confidence >= model.threshold) or out[i].engine == "fallback" for i in (2, 3))
    assert ca.classify(model, rows.limit(0)).count() == 0


def test_calibration_is_monotone_and_bounded(spark):
    rows = spark.range(20000).select((F.rand(1) * 0.5 + 0.5).alias("c"), F.rand(2).alias("u"))
    rows = rows.select("c", (F.col("u") < F.col("c") * F.col("c")).alias("right"))
    model = ca.calibrate(rows, "c", "right")
    points = spark.createDataFrame([(x / 20,) for x in range(21)], "c double")
    got = [r.p for r in ca.with_chance(points, model, "c", "p").orderBy("c").collect()]
    assert got == sorted(got) and abs(got[16] - 0.64) < 0.1
    assert ca.calibrate(rows.limit(0), "c", "right") is None


def test_a_pandas_scorer_may_be_the_second_tier(spark, fitted):
    """The word list answers where tier 1 is under the threshold (here always); without a listed word it does not."""
    from murmur.operators.sentiment import classify_cascade, lexicon_fallback
    model, _ = fitted
    rows = spark.createDataFrame([(1, "good great bad"), (2, "nothing listed"), (3, "bad")], "id int, content string")
    out = {r.id: (r.sentiment, r.engine) for r in classify_cascade(model.bulk, rows, threshold=1.1, fallback=lexicon_fallback).collect()}
    assert out == {1: ("positive", "fallback"), 2: (None, "fallback"), 3: ("negative", "fallback")}
