"""Exact deduplication: group by a 128-bit content hash, compare the bytes inside groups.

One row per distinct (hash, text) is made by an aggregate with both as keys: partial aggregation
collapses a hot group on each task, and rows meet only if the hash agrees and every byte does. Texts
whose hash collides thus stay apart; the rows of the table find their group again by hash and SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = "[\\x20\\x09-\\x0D]+"


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blanks: str = BLANKS, digest=content_hash) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting every match of `blanks`; null counts as empty, so
    null, empty and blank texts are one group. Of a group the row with the most code points in the
    original text stays, then the smallest id (a null id comes last). Repeated rows with one id
    count as many rows; all of them are kept if that id stays. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.regexp_replace(text, blanks, "").alias("text"), F.length(text).cast("long").alias("n"))
    rows = rows.select("doc_id", "n", "text", digest(F.col("text")).alias("h"))
    # longest first, then smallest id: the id is negated so that one maximum serves, null last
    best = F.max(F.struct("n", (-F.col("doc_id")).alias("id")))
    groups = rows.groupBy("h", "text").agg(F.count("*").alias("group_size"), best.alias("best"))
    groups = groups.select("h", F.sha2("text", 256).alias("text_sha256"), (-F.col("best.id")).alias("keep_id"), "group_size")
    out = rows.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256")).join(groups, ["h", "text_sha256"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
