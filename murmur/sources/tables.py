"""Loading the input tables.

Every table is one parquet dataset under ``sf_dir``. Reads are lazy: callers select the columns they
need and filter early, so Catalyst prunes the scan (``ReadSchema``) and pushes predicates into the
parquet reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the base tables as temp views (for `spark.sql` users)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
