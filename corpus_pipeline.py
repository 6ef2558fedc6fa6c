"""Cleaning and packing of a corpus: STAGES in order, each written as Parquet and reread by the next.

Filtering stages judge row by row: where an id is null or repeated, rows are numbered in the order of
their ids (then texts), so a row never goes for another one's text. Extra columns of the documents are
not carried on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm.common import small, stored, table
from murmur.llm.decontam import decontaminate
from murmur.llm.exact import exact_duplicates
from murmur.llm.minhash import near_duplicates
from murmur.llm.packing import pack
from murmur.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def numbered(docs: DataFrame) -> DataFrame:
    """The columns of documents and `row`, a long of its own for each row in the order of doc_id (null last):
    the id itself if all are set and different, else numbers of a stored copy sorted by id and text."""
    clash = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1)
    if not clash.count():
        return docs.select(*COLUMNS, F.col("doc_id").cast("long").alias("row"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(docs.select(*COLUMNS).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()), "numbered")


def without(rows: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows whose number is not in `gone` (stored, and broadcast if few), with the columns of documents."""
    return rows.join(small(stored(gone.distinct(), name)), "row", "left_anti").select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    rows = numbered(docs)
    labels = table(spark, sf_dir, "labels").where("crc32(CAST(CAST(doc_id AS BIGINT) AS STRING)) % 4 <> 2")
    labels = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "row").join(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), "doc_id").select(F.col("row").alias("doc_id"), "toxic")
    return without(rows, toxicity(rows, labels, id_col="row").where("predicted = 1").select(F.col("doc_id").alias("row")), "toxic")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (white space aside) stays, of repeated rows of one id too."""
    rows = numbered(docs)
    return without(rows, exact_duplicates(rows, id_col="row").where("not kept").select(F.col("doc_id").alias("row")), "copies")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the smallest id stays."""
    rows = numbered(docs)
    return without(rows, near_duplicates(rows, words=5, percent=80, id_col="row").where("not kept").select(F.col("doc_id").alias("row")), "near")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more lie in benchmark windows go."""
    rows = numbered(docs)
    return without(rows, decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col="row").where("contaminated").select(F.col("doc_id").alias("row")), "contaminated")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full training windows that the documents' tokens fill."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", reject_toxic), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: The classifier, the sketches and the packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
