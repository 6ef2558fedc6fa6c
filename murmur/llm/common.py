"""Shared Spark helpers of the operators: scratch tables, size-checked broadcast, components."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import bound_batches, scratch_path

#: Rows (of a few longs each) up to which a counted side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """`mapInArrow` with batches of bounded bytes (`bound_batches`); for `DataFrame.transform`."""
    bound_batches(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        give_back()  # the worker waits for its next task without it
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system. Arrow's pool and the C library (what numpy freed) keep it otherwise, and
    an executor's idle workers would hold the peaks of all their tasks beside a grown heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back: a lineage cut that outlives
    executors. A new folder each time, so that a retry or a second call never meets an old one."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if its counted rows are at most `rows`, else as it is. Give it a
    stored table: it is counted from the files' footers."""
    return F.broadcast(df) if df.count() <= rows else df


def components(links: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of the undirected `links` (a long, b long).

    Returns (node, root) for every node of a link between two different nodes. Contraction: every
    node points to the neighbour (or itself) that comes first by a hash order, links move to those,
    loops and repeats go, until none are left; the hash order makes the rounds logarithmic for
    chains too. Each round is written to the shared folder. A hot node is pre-aggregated.
    """
    spark = links.sparkSession
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    nodes = None
    while links.count():
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("m"))
                        .select("node", F.least(F.col("m"), order("node"))["id"].alias("parent")), name)
        up = lambda c: parent.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_up"))
        links = stored(links.join(up("a"), "a").join(up("b"), "b").where("a_up <> b_up")
                       .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), name)
        if nodes is None:
            nodes = parent.select("node", F.col("parent").alias("root"))
        else:
            step = parent.select(F.col("node").alias("root"), F.col("parent").alias("next"))
            nodes = stored(nodes.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), name)
    if nodes is None:
        return spark.createDataFrame([], "node long, root long")
    return nodes


def links_of_shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes (same, id) of `rows` (doc_id, same) that hold one doc_id: a class
    holds rows of equal texts, and rows of one id are one node."""
    rows = stored(rows.select("doc_id", "same").distinct().join(classes.select("same", "id"), "same").select("doc_id", "id"), "rows")
    shared = rows.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("doc_id", "a")
    return rows.join(shared, "doc_id").select("a", F.col("id").alias("b"))
