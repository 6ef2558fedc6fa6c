"""Streaming job intake. Messages (key, JSON value) arrive as files here; with a broker the
source is `readStream.format("kafka")` and the rest of the plan is unchanged. Each micro-batch is
decoded (A7), validated (C19) and fanned out to sources (D4); malformed jobs are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import fixtures as fx
from murmur.operators import jobs as jb
from murmur.streaming.common import new_location, read_batches, run_available, write_batch

MESSAGE_SCHEMA = "job_id long, value string"


def write_messages(spark: SparkSession, sf_dir: str) -> str:
    """Publish the job messages derived from the input tables as JSON-lines files (B7 sink)."""
    path = new_location(spark, "topics", "jobs")
    jb.publish(fx.job_messages(spark, sf_dir), path)
    return path


def job_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2).json(path)


def run_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = write_messages(spark, sf_dir)
    out = new_location(spark, "tables", "jobs_decoded")
    decoded = jb.validate(jb.decode(job_stream(spark, src)))
    run_available(decoded, lambda b, i: write_batch(b, out, i), "job_decode")
    return read_batches(spark, out, "job_id long").drop("batch_id")


def run_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = write_messages(spark, sf_dir)
    out = new_location(spark, "tables", "jobs_fanout")
    plan = jb.fan_out(jb.validate(jb.decode(job_stream(spark, src)))).select("job_id", "keyword", "source")
    run_available(plan, lambda b, i: write_batch(b, out, i), "job_fanout")
    return read_batches(spark, out, "job_id long, keyword string, source string").drop("batch_id")


def json_dir_to_messages(spark: SparkSession, path: str, pattern: str = "*json") -> DataFrame:
    """Every file under `path` (any depth, names like `pattern`) -> one message with the file's
    JSON value, compact and with sorted keys; an unreadable file gives `{}`. Each file is read whole,
    without inferring a schema, so values keep their types and nulls."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return df.select(F.coalesce(F.to_json(F.try_parse_json("value")), F.lit("{}")).alias("value"))


def run_json_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lay the job messages out as nested folders with one JSON array per file (a job's ids never
    straddle files: one file per bucket of a hundred jobs), then load them back (A8)."""
    path = new_location(spark, "topics", "jobs_tree")
    msgs = fx.job_messages(spark, sf_dir).withColumn("bucket", F.floor(F.col("job_id") / 100))
    files = msgs.groupBy("bucket").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("job_id", "value"))), lambda m: m["value"]), ",\n  ").alias("v"))
    (files.select("bucket", F.concat(F.lit("[\n  "), F.col("v"), F.lit("\n]")).alias("value"))
     .repartition("bucket").write.partitionBy("bucket").option("lineSep", "\n").text(path))
    return json_dir_to_messages(spark, path, "*.txt")
