"""Shared streaming plumbing: file-stream sources over the input folders, `availableNow` runs with
checkpoints in the shared checkpoint folder, and idempotent per-batch outputs."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import scratch_path
from murmur.sources.tables import table_path


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """A file stream over one input table, a single file or a folder of part files; `max_files`
    bounds the size of each micro-batch. The braces make the path a pattern that matches just this
    table: a plain path would have to be a folder."""
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(table_path(sf_dir, f"{{{name}}}")))


def new_location(spark: SparkSession, kind: str, name: str) -> str:
    return scratch_path(spark, f"{kind}/{name}-{uuid.uuid4().hex[:10]}")


def run_available(df: DataFrame, batch_fn, name: str, checkpoint: str | None = None,
                  output_mode: str = "append") -> str:
    """Process everything available now through `batch_fn(batch_df, batch_id)`, then stop.
    Returns the checkpoint location (re-running with it resumes; a new one replays)."""
    ckpt = checkpoint or new_location(df.sparkSession, "checkpoints", name)
    q = (df.writeStream.queryName(f"{name}_{uuid.uuid4().hex[:6]}").outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return ckpt


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent micro-batch output: a replayed batch overwrites its own directory."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The batches written below `path`; empty if no batch produced output."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def ntz_as_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall time) -> TIMESTAMP instant, independent of the session zone
    (`withWatermark` needs TIMESTAMP)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
