"""Fixed schemas of the raw zone (R), the warehouse tables (C contents, M comments) and jobs."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW = _struct(
    ("ingest_seq", L, False), ("type", S, True), ("source", S, True), ("keyword", S, True), ("url", S, True),
    ("content_id", S, True), ("title", S, True), ("media", S, True), ("desc", S, True),
    ("published_at", S, True), ("content_url", S, True), ("parent_id", S, True), ("raw", S, True))

CONTENTS = _struct(
    ("source_id", S, False), ("source", S, False), ("keyword", S, False), ("url", S, True),
    ("content_id", S, True), ("title", S, True), ("author", S, True), ("media", S, True),
    ("content", S, True), ("published_at", S, True), ("published_ts", T.TimestampNTZType(), True),
    ("raw_id", L, True))

COMMENTS = _struct(
    ("source_id", S, False), ("source", S, False), ("keyword", S, False), ("content_id", S, True),
    ("content_url", S, True), ("raw_parent_id", S, True), ("raw_id", L, True), ("author", S, True),
    ("content", S, True), ("prokontra", S, True), ("published_at", S, True),
    ("published_ts", T.TimestampNTZType(), True), ("sentiment", S, True), ("engine", S, True),
    ("confidence", D, True), ("ai_processed", B, True))

JOB = _struct(("keyword", S, True), ("interval", S, True), ("platforms", S, True), ("news_sources", S, True),
              ("force", B, True), ("limit", T.IntegerType(), True))
