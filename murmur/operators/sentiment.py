"""Sentiment stage: unprocessed selection (C21), cascade routing (K2), bulk-model training (K4),
the two-tier classifier (K1), keyed label updates (B4/D5) and the engine report input (E10).

Tier 1 is a Spark ML pipeline (tokenizer -> hashed term frequencies -> IDF -> multinomial logistic
regression), trained and applied inside the JVM. Rows under the confidence threshold, and only
those, go to tier 2, a pluggable vectorised scorer (a pandas UDF over Arrow batches). The default
tier 2 is a small lexicon scorer standing in for an external model; it may return no label, in
which case the row stays unprocessed and is picked up again on the next pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions.text import WORD_SPLIT
from murmur.operators.warehouse import keyed_update, replace_table

CONFIDENCE_THRESHOLD = 0.75
BULK, FALLBACK = "bulk", "fallback"


def unprocessed(comments: DataFrame) -> DataFrame:
    """Rows still to label: not processed and with content (empty string counts, NULL does not)."""
    return comments.where(~F.col("ai_processed") & F.col("content").isNotNull())


def under(confidence: str, threshold: float):
    """Whether tier 2 answers: the confidence is missing or below the threshold."""
    return F.coalesce(F.col(confidence) < threshold, F.lit(True))


def cascade_routing(scored: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """K2: which tier answers a row, given its tier-1 confidence."""
    low = under("confidence", threshold)
    return scored.withColumn("engine", F.when(low, FALLBACK).otherwise(BULK)).withColumn("needs_fallback", low)


def train_bulk_model(labelled: DataFrame, text_col: str = "content", label_col: str = "sentiment",
                     num_features: int = 1 << 16, max_iter: int = 30, min_doc_freq: int = 0) -> PipelineModel:
    """K4: fit the tier-1 model on labelled texts (distributed: treeAggregate gradient steps).

    Texts are tokenised and hashed once: the term-frequency vectors (not the texts) are persisted
    (MEMORY_AND_DISK, recomputed from lineage if an executor is lost) for the IDF and regression
    passes, and released after the fit.
    """
    prep = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"),
        RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=WORD_SPLIT, gaps=True, toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
    ]).fit(labelled.select(label_col))          # the indexer needs the labels only
    feats = (prep.transform(labelled.select(text_col, label_col)).select("label", "_tf")
             .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        tail = Pipeline(stages=[
            IDF(inputCol="_tf", outputCol="_features", minDocFreq=min_doc_freq),
            LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial",
                               maxIter=max_iter, regParam=0.01, probabilityCol="_prob", predictionCol="_pred",
                               rawPredictionCol="_raw"),
        ]).fit(feats)
    finally:
        feats.unpersist()
    return PipelineModel(stages=prep.stages + tail.stages)


def score_bulk(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Tier 1: label and confidence (the top class probability) for every row."""
    labels = model.stages[0].labels
    out = PipelineModel(stages=model.stages[1:]).transform(texts)   # the label indexer is for training only
    out = IndexToString(inputCol="_pred", outputCol="_label", labels=labels).transform(out)
    keep = [c for c in texts.columns]
    return out.select(*keep, F.col("_label").alias("bulk_label"),
                      F.array_max(vector_to_array("_prob")).alias("bulk_confidence"))


# The default tier-2 lexicon (a stand-in for the external fallback model).
POSITIVE_WORDS = ("good great love best happy thanks excellent agree bagus baik setuju suka mantap bon "
                  "bien gut super bueno").split()
NEGATIVE_WORDS = ("bad worst hate angry sad wrong terrible disagree buruk jelek benci marah salah tolak "
                  "mal mauvais schlecht malo").split()


def _lexicon_scores(texts: pd.Series, pos: frozenset, neg: frozenset) -> pd.DataFrame:
    toks = texts.fillna("").str.lower().str.findall(r"[^\W_]+")
    p = toks.map(lambda ws: sum(w in pos for w in ws))
    n = toks.map(lambda ws: sum(w in neg for w in ws))
    hit = (p + n) > 0
    label = pd.Series(None, index=texts.index, dtype="object")
    label[hit & (p > n)] = "positive"
    label[hit & (n > p)] = "negative"
    label[hit & (n == p)] = "neutral"
    conf = ((p - n).abs() / (p + n).where(hit)).astype("float64")
    return pd.DataFrame({"label": label, "confidence": conf})


@F.pandas_udf(T.StructType([T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType())]))
def lexicon_fallback(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Default tier 2: lexicon polarity; no label when the text has no lexicon word at all.

    Iterator form: whatever the scorer needs (here the word sets; for a real fallback model, its
    weights or client) is set up once per task, then every Arrow batch is scored with it.
    """
    pos, neg = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)
    for texts in batches:
        yield _lexicon_scores(texts, pos, neg)


def classify_cascade(model: PipelineModel, texts: DataFrame, text_col: str = "content",
                     threshold: float = CONFIDENCE_THRESHOLD, fallback=lexicon_fallback) -> DataFrame:
    """K1: tier 1 for every row; tier 2 only for the rows under the threshold.

    One pass: tier 1 is scored once in the JVM; every row goes through the Python worker, but the text
    only where tier 1 is under the threshold (NULL elsewhere). Output adds sentiment, engine, confidence (NULL sentiment = no answer; the row stays
    unprocessed and is picked up again).
    """
    scored = score_bulk(model, texts)
    low = under("bulk_confidence", threshold)
    scored = scored.withColumn("_t2", fallback(F.when(low, F.col(text_col))))
    return scored.select(
        *texts.columns,
        F.when(low, F.col("_t2.label")).otherwise(F.col("bulk_label")).alias("sentiment"),
        F.when(low, F.lit(FALLBACK)).otherwise(F.lit(BULK)).alias("engine"),
        F.when(low, F.col("_t2.confidence")).otherwise(F.col("bulk_confidence")).alias("confidence"))


def apply_labels(comments: DataFrame, labels: DataFrame, keys=("source", "source_id")) -> DataFrame:
    """Write sentiment, engine, confidence and ai_processed=true for labelled keys; rows the
    classifier answered nothing for keep ai_processed=false (Q16)."""
    answered = labels.where(F.col("sentiment").isNotNull()).select(*keys, "sentiment", "engine", "confidence")
    target = comments
    for c, t in (("engine", T.StringType()), ("confidence", T.DoubleType()), ("sentiment", T.StringType())):
        if c not in target.columns:
            target = target.withColumn(c, F.lit(None).cast(t))
    return keyed_update(target, answered, keys=keys, set_cols=("sentiment", "engine", "confidence"),
                        flag=("ai_processed", True))


def label_pass(comments: DataFrame, scorer, base_path: str) -> str:
    """One labelling pass over the comments table: unprocessed rows -> `scorer(rows)` (the rows' keys with
    sentiment, engine, confidence; the cascade or any other) -> labels written into a new version
    of the table below `base_path`. Returns that version's path; the caller points readers to it.
    Rows without an answer stay unprocessed and are met again by the next pass."""
    labels = scorer(unprocessed(comments))
    return replace_table(apply_labels(comments, labels), base_path)


def cascade_scorer(model: PipelineModel, keys=("source", "source_id"), **options):
    """A scorer for `label_pass` from the two-tier classifier."""
    return lambda rows: classify_cascade(model, rows.select(*keys, "content"), **options).select(*keys, "sentiment", "engine", "confidence")
