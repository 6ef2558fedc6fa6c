"""The trained two-tier classifier (K1) with calibrated confidences, and its held-out quality (K1/K4).

Both tiers are Spark ML models, fitted and applied inside the JVM. Tier 1 is the word model of
`sentiment.train_bulk_model`; tier 2 reads character n-grams (spelling variants, word parts) and is
fitted on the rows that tier 1 is unsure of. A model's top probability is not the chance that it is
right, so each tier's confidence is mapped to one by isotonic regression on rows that it was not
fitted on. The threshold of the cascade is then a wanted accuracy.

The labelled rows are dealt to three parts by a hash of the text, so that copies of a text share a part:
`fit` (tier 1), `second` (tier 2) and `calibrate` (both confidences).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, NGram, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.operators.sentiment import BULK, CONFIDENCE_THRESHOLD, FALLBACK, score_bulk, train_bulk_model, under

#: Hundredths of the labelled rows per part; `calibrate` takes the rest.
FIT_SHARE, SECOND_SHARE = 50, 30
#: Confidences are counted on a grid of this many steps before the isotonic fit, which ends in one task.
GRID = 1000
GRAMS = (2, 3, 4)


def text_part(text: str, parts: int = 100, salt: str = "cascade") -> Column:
    """The part (0 to `parts` - 1) that a text is dealt to: equal texts share one."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col(text)), F.lit(parts))


@dataclass(frozen=True)
class Cascade:
    """Two fitted tiers, each with the map of its confidence (None: the confidence as it is)."""

    bulk: PipelineModel
    bulk_chance: IsotonicRegressionModel | None
    second: PipelineModel
    second_chance: IsotonicRegressionModel | None
    threshold: float = CONFIDENCE_THRESHOLD


def calibrate(scored: DataFrame, confidence: str, right: str) -> IsotonicRegressionModel | None:
    """Isotonic map of a confidence to the share of right answers, from rows that the model was not fitted on.

    Rows are counted per step of the confidence (at most `GRID` + 1 rows whatever the table's size) and
    the counts weigh the steps. Null confidences are left out; None if there is no row.
    """
    step = F.round(F.col(confidence) * GRID) / GRID
    counts = (scored.where(F.col(confidence).isNotNull()).groupBy(step.alias("features"))
              .agg(F.avg(F.col(right).cast("double")).alias("label"), F.count("*").cast("double").alias("weight")).coalesce(1))
    if counts.isEmpty():
        return None
    return IsotonicRegression(weightCol="weight").fit(counts)


def with_chance(df: DataFrame, model: IsotonicRegressionModel | None, confidence: str, to: str) -> DataFrame:
    """`df` with the calibrated form of `confidence` (between two steps by linear interpolation) in `to`."""
    if model is None:
        return df.withColumn(to, F.col(confidence))
    model = model.copy().setFeaturesCol(confidence).setPredictionCol(to)
    return model.transform(df)


def train_ngram_model(labelled: DataFrame, text_col: str = "content", label_col: str = "sentiment", grams=GRAMS,
                      num_features: int = 1 << 16, max_iter: int = 30) -> PipelineModel:
    """Tier 2: multinomial regression over hashed character n-grams of the lengths `grams`.

    As in `train_bulk_model` the vectors, not the texts, are persisted for the passes of the fit.
    """
    stages = [StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"),
              RegexTokenizer(inputCol=text_col, outputCol="_chars", pattern="(?s).", gaps=False, toLowercase=True, minTokenLength=0)]
    stages += [NGram(n=n, inputCol="_chars", outputCol=f"_grams{n}") for n in grams]
    together = ", ".join(f"_grams{n}" for n in grams)
    stages += [SQLTransformer(statement=f"SELECT *, concat({together}) AS _all FROM __THIS__"),
               HashingTF(inputCol="_all", outputCol="_tf", numFeatures=num_features)]
    prep = Pipeline(stages=stages).fit(labelled.select(label_col, text_col))
    feats = prep.transform(labelled.select(text_col, label_col)).select("label", "_tf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tail = Pipeline(stages=[
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", maxIter=max_iter,
                               regParam=0.01, probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_raw"),
        ]).fit(feats)
    finally:
        feats.unpersist()
    return PipelineModel(stages=prep.stages + tail.stages)


def score_ngram(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Tier 2: `second_label` and `second_confidence` for every row."""
    out = PipelineModel(stages=model.stages[1:]).transform(texts)
    out = IndexToString(inputCol="_pred", outputCol="_label", labels=model.stages[0].labels).transform(out)
    return out.select(*texts.columns, F.col("_label").alias("second_label"),
                      F.array_max(vector_to_array("_prob")).alias("second_confidence"))


def train_cascade(labelled: DataFrame, text_col: str = "content", label_col: str = "sentiment",
                  threshold: float = CONFIDENCE_THRESHOLD, num_features: int = 1 << 16, max_iter: int = 30) -> Cascade:
    """K1: fit both tiers and both calibrations on labelled texts.

    Rows without a text or a label are left out. Tier 2 is fitted on the rows of its part whose
    calibrated tier-1 confidence is under the threshold; where these hold fewer than two labels (tier 1 is
    sure of nearly all), on its whole part, so that it always has an answer.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("content"), F.col(label_col).alias("sentiment"))
    rows = rows.where(F.col("content").isNotNull() & F.col("sentiment").isNotNull()).withColumn("_part", text_part("content"))
    fit = rows.where(F.col("_part") < FIT_SHARE)
    bulk = train_bulk_model(fit, num_features=num_features, max_iter=max_iter)

    rest = score_bulk(bulk, rows.where(F.col("_part") >= FIT_SHARE)).withColumn("_right", F.col("bulk_label") == F.col("sentiment"))
    rest = rest.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = F.col("_part") >= FIT_SHARE + SECOND_SHARE
        bulk_chance = calibrate(rest.where(held), "bulk_confidence", "_right")
        judged = with_chance(rest, bulk_chance, "bulk_confidence", "_chance").withColumn("_low", under("_chance", threshold))
        unsure = judged.where(~held & F.col("_low"))
        labels = unsure.agg(F.count_distinct("sentiment")).first()[0]
        second = train_ngram_model(unsure if labels > 1 else rest.where(~held), num_features=num_features, max_iter=max_iter)
        seen = judged.where(held & F.col("_low")) if labels > 1 else judged.where(held)
        seen = score_ngram(second, seen).withColumn("_right", F.col("second_label") == F.col("sentiment"))
        second_chance = calibrate(seen, "second_confidence", "_right")
    finally:
        rest.unpersist()
    return Cascade(bulk, bulk_chance, second, second_chance, threshold)


def score_tiers(cascade: Cascade, texts: DataFrame, text_col: str = "content") -> DataFrame:
    """The rows with both tiers' labels and calibrated chances, and `low`: tier 2 answers.

    One pass in the JVM. Tier 2 is given the text only where tier 1 is under the threshold, an empty one
    elsewhere. A null text is scored as an empty one here.
    """
    cols = texts.columns
    rows = texts.select(F.struct(*cols).alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("content"))
    rows = with_chance(score_bulk(cascade.bulk, rows), cascade.bulk_chance, "bulk_confidence", "bulk_chance")
    rows = rows.withColumn("low", under("bulk_chance", cascade.threshold))
    rows = rows.withColumn("content", F.when(F.col("low"), F.col("content")).otherwise(F.lit("")))
    rows = with_chance(score_ngram(cascade.second, rows), cascade.second_chance, "second_confidence", "second_chance")
    return rows.select("_row", "low", "bulk_label", "bulk_confidence", "bulk_chance", "second_label", "second_confidence", "second_chance")


def classify(cascade: Cascade, texts: DataFrame, text_col: str = "content") -> DataFrame:
    """K1: the columns of `texts` with sentiment, engine and (calibrated) confidence.

    A null text gets no sentiment, engine or confidence (it stays unprocessed); an empty one is classified (Q17).
    Columns of `texts` named like the three results are replaced.
    """
    rows = score_tiers(cascade, texts, text_col)
    there = F.col(f"_row.`{text_col}`").isNotNull()
    keep = [F.col(f"_row.`{c}`").alias(c) for c in texts.columns if c not in ("sentiment", "engine", "confidence")]
    pick = lambda second, bulk: F.when(there & F.col("low"), second).when(there, bulk)
    return rows.select(*keep, pick(F.col("second_label"), F.col("bulk_label")).alias("sentiment"),
                       pick(F.lit(FALLBACK), F.lit(BULK)).alias("engine"),
                       pick(F.col("second_chance"), F.col("bulk_chance")).alias("confidence"))


def trained_scorer(cascade: Cascade, keys=("source", "source_id")):
    """A scorer for `sentiment.label_pass` from the trained cascade."""
    return lambda rows: classify(cascade, rows.select(*keys, "content")).select(*keys, "sentiment", "engine", "confidence")


def quality(scored: DataFrame, by: list, label: str, answer: str, confidence: str, bins: int = 10) -> DataFrame:
    """Accuracy and expected calibration error per `by`: n, accuracy, calibration_error.

    The error is the mean over rows of |share of right answers - mean confidence| of the row's bin. Rows without
    an answer count as wrong with confidence 0. One aggregate per (by, bin), a second over the few bins.
    """
    right = F.coalesce((F.col(label) == F.col(answer)).cast("double"), F.lit(0.0))
    sure = F.coalesce(F.col(confidence), F.lit(0.0))
    bin_ = F.least(F.floor(sure * bins), F.lit(bins - 1))
    cells = scored.groupBy(*by, bin_.alias("_bin")).agg(F.count("*").alias("_n"), F.sum(right).alias("_right"), F.sum(sure).alias("_sure"))
    n = F.sum("_n")
    return cells.groupBy(*by).agg(n.alias("n"), (F.sum("_right") / n).alias("accuracy"),
                                  (F.sum(F.abs(F.col("_right") - F.col("_sure"))) / n).alias("calibration_error"))


def cascade_quality(cascade: Cascade, labelled: DataFrame, text_col: str = "content", label_col: str = "sentiment") -> DataFrame:
    """Quality on labelled rows that `train_cascade` has not seen, one row per view: `bulk_raw` (tier 1 with
    its own probability), `bulk` (calibrated), `fallback` (tier 2 on the rows it answers), `cascade`."""
    rows = score_tiers(cascade, labelled, text_col).withColumn("_label", F.col(f"_row.`{label_col}`"))
    low = F.col("low")
    view = lambda name, answer, sure: F.struct(F.lit(name).alias("view"), answer.alias("answer"), sure.alias("sure"))
    views = F.array(view("bulk_raw", F.col("bulk_label"), F.col("bulk_confidence")),
                    view("bulk", F.col("bulk_label"), F.col("bulk_chance")),
                    F.when(low, view("fallback", F.col("second_label"), F.col("second_chance"))),
                    view("cascade", F.when(low, F.col("second_label")).otherwise(F.col("bulk_label")),
                         F.when(low, F.col("second_chance")).otherwise(F.col("bulk_chance"))))
    long = rows.select("_label", F.explode(F.filter(views, lambda v: v.isNotNull())).alias("v")).select("_label", "v.*")
    return quality(long, ["view"], "_label", "answer", "sure")
