"""The continuous cleaner. New raw-zone files -> cleaner -> idempotent warehouse inserts.

The raw zone is a parquet folder partitioned by (type, source). Each micro-batch runs the batch
cleaner (routing, extraction, time parsing) and appends only keys the warehouse does not have yet,
so at-least-once delivery and a full replay from the start insert nothing twice. Articles whose key the
warehouse has are not parsed again. Rejected rows are inserted likewise, by row and reason. Authors
are pseudonymised before anything is stored. The stream checkpoint replaces a per-row checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur import schemas as S
from murmur.functions.hashing import hmac_sha256
from murmur.operators import cleaner as cl
from murmur.operators import warehouse as wh
from murmur.streaming.common import run_available


REJECTS = T.StructType([T.StructField("ingest_seq", T.LongType()), T.StructField("type", T.StringType()),
                        T.StructField("source", T.StringType()), T.StructField("reason", T.StringType())])


def clean_batch(spark: SparkSession, paths: dict[str, str], secret: str | bytes | None):
    def fn(batch: DataFrame, batch_id: int) -> None:
        known = wh.read_or_empty(spark, paths["contents"], S.CONTENTS)
        contents, comments, _ = cl.clean(cl.fresh(batch, known))
        private = lambda df: df.withColumn("author", hmac_sha256("author", secret) if secret else F.lit(None).cast("string"))
        for c, t in (("sentiment", "string"), ("engine", "string"), ("confidence", "double")):
            comments = comments.withColumn(c, F.lit(None).cast(t))
        comments = comments.withColumn("ai_processed", F.lit(False))
        wh.insert_ignore(spark, private(contents), paths["contents"], S.CONTENTS)
        wh.insert_ignore(spark, private(comments), paths["comments"], S.COMMENTS)
        wh.insert_ignore(spark, cl.rejects(batch), paths["rejects"], REJECTS, keys=("ingest_seq", "reason"), order_col="ingest_seq")
    return fn


def run_clean(spark: SparkSession, raw_path: str, warehouse: str, checkpoint: str | None = None,
              max_files: int = 64, secret: str | bytes | None = None) -> dict[str, str]:
    """Clean what is in the raw zone now. Authors are stored as keyed pseudonyms under `secret`, and not
    at all without one."""
    paths = wh.ensure_tables(spark, warehouse)
    paths["rejects"] = f"{warehouse.rstrip('/')}/rejects"
    stream = spark.readStream.schema(S.RAW).option("maxFilesPerTrigger", max_files).parquet(raw_path)
    run_available(stream, clean_batch(spark, paths, secret), "clean", checkpoint=checkpoint)
    return paths
