"""Raw-zone reads and warehouse maintenance: incremental scan (A1), paged find (A2), first match (A3),
count (A4), match-group-sort (A5), parameterised SQL (A6), raw append (B1), conflict-ignoring inserts
(B2/B3, D2), keyed updates (B4/B5), deletes (B6), table setup (B8).

Parquet tables have no MERGE, so "insert, ignore duplicates" is a first-wins dedupe of the incoming
rows (an aggregate, collapsing repeated keys map-side) plus a left anti join against the target's
keys; updates and deletes write a new version directory that replaces the old one only after the
write has succeeded, so a lost executor or a failed job never leaves a half-written table.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur import schemas as S
from murmur.session import scratch_path

WAREHOUSE_KEYS = ("source", "source_id")


# ---------------------------------------------------------------- reads

def incremental_scan(raw: DataFrame, high_water_mark: int | None, seq_col: str = "ingest_seq") -> DataFrame:
    """A1/G1: rows after the checkpoint in ingest order. The predicate is pushed into the scan."""
    df = raw if high_water_mark is None else raw.where(F.col(seq_col) > F.lit(high_water_mark))
    return df.orderBy(seq_col)


def late_rows(batch: DataFrame, high_water_mark: int, seq_col: str = "ingest_seq") -> DataFrame:
    """J4 (batch form): rows arriving at or below the checkpoint would never be read by an
    incremental scan; they are routed to a `late` rejects table instead of being lost."""
    return batch.where(F.col(seq_col) <= F.lit(high_water_mark)).withColumn("reason", F.lit("late"))


def find_page(df: DataFrame, cond: Column | None, columns: list[str], order: list[Column | str],
              skip: int = 0, limit: int | None = None, after: tuple | None = None) -> DataFrame:
    """Filtered, projected, sorted, paged read (skip + limit).

    `after` holds the `order` columns' values (ascending, named) of the last row of the page before:
    rows up to it are left out by a predicate, which reaches the scan, where `skip` has to sort and
    pass over them; deep or open-ended pages should use it.
    """
    out = df if cond is None else df.where(cond)
    if after is not None:
        last = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after)]
        out = out.where(F.struct(*order) > F.struct(*last) if len(order) > 1 else F.col(order[0]) > last[0])
    out = out.select(*columns).orderBy(*order)
    if skip:
        out = out.offset(skip)
    if limit:
        out = out.limit(limit)
    return out


def find_first(df: DataFrame, cond: Column | None, order: list[Column | str]) -> DataFrame:
    """A3: first match after sorting; an empty DataFrame (not an error) when nothing matches."""
    out = df if cond is None else df.where(cond)
    return out.orderBy(*order).limit(1)


def count_where(df: DataFrame, cond: Column | None) -> DataFrame:
    """A4: one row `n` with the number of matching rows."""
    out = df if cond is None else df.where(cond)
    return out.agg(F.count(F.lit(1)).alias("n"))


def match_group_sort(df: DataFrame, cond: Column | None, keys: list[str], aggs: list[Column],
                     order: list[Column | str]) -> DataFrame:
    """A5 (re-aimed from a store-side pipeline): where -> groupBy/agg -> orderBy."""
    out = df if cond is None else df.where(cond)
    return out.groupBy(*keys).agg(*aggs).orderBy(*order)


def param_sql(spark: SparkSession, text: str, args: dict, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL over DataFrames (named `:markers` bound as literals, never spliced)."""
    return spark.sql(text, args=args, **frames)


# ---------------------------------------------------------------- writes

def with_ingest_timestamps(raw: DataFrame, now: datetime) -> DataFrame:
    """B1: default created_at/updated_at to `now` when missing (a literal: one value per run)."""
    ts = F.expr(f"TIMESTAMP_NTZ '{now:%Y-%m-%d %H:%M:%S}'")
    out = raw
    for c in ("created_at", "updated_at"):
        out = out.withColumn(c, F.coalesce(F.col(c), ts) if c in raw.columns else ts)
    return out


def append_raw(raw: DataFrame, path: str, now: datetime | None = None) -> None:
    """B1: append to the raw zone, partitioned by (type, source) so routing filters prune files; with
    `now`, rows without ingest timestamps get it."""
    rows = raw if now is None else with_ingest_timestamps(raw, now)
    rows.write.mode("append").partitionBy("type", "source").parquet(path)


def first_wins(incoming: DataFrame, keys=WAREHOUSE_KEYS, order_col: str = "raw_id", winners: DataFrame | None = None) -> DataFrame:
    """Q1/B2: one row per key, the earliest by `order_col` (the first keyword that found it wins; ties by a
    hash of the row).

    Only keys, order and hash are aggregated (a hot key collapses in each task before the shuffle),
    then the rows are semi-joined to the winners, so bodies are never sorted or buffered in an
    aggregate. Rows equal in all of these are repeats of one row: just they are reduced by key.
    """
    ranked, first = _ranked(incoming, keys, order_col)
    first = first if winners is None else winners
    k = [*keys, "_order", "_hash"]
    once = ranked.join(first.where("_n = 1"), k, "left_semi")
    again = ranked.join(first.where("_n > 1"), k, "left_semi").dropDuplicates(list(keys))
    return once.unionByName(again).select(*incoming.columns)


def _ranked(incoming: DataFrame, keys, order_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows with order and hash, and per key the first (order, hash) with its number of rows."""
    ranked = incoming.withColumn("_order", F.col(order_col)).withColumn("_hash", F.xxhash64(*incoming.columns))
    rows = ranked.groupBy(*keys, "_order", "_hash").agg(F.count(F.lit(1)).alias("_n"))
    first = rows.groupBy(*keys).agg(F.min(F.struct("_order", "_hash", "_n")).alias("_f")).select(*keys, "_f.*")
    return ranked, first


def new_rows(incoming: DataFrame, existing_keys: DataFrame, keys=WAREHOUSE_KEYS,
             order_col: str = "raw_id") -> DataFrame:
    """`INSERT ... ON CONFLICT (source, source_id) DO NOTHING` as a DataFrame: the batch's
    first rows per key without the keys that the target has.

    Both steps run on keys alone. The target's keys are first semi-joined with the batch's: for a
    micro-batch that side is small, so AQE broadcasts it and the warehouse is scanned for its key
    columns (pruned to the batch's `source` partitions) without a shuffle.
    """
    k = list(keys)
    _, first = _ranked(incoming, keys, order_col)
    hits = existing_keys.select(*k).join(first.select(*k), k, "left_semi")
    return first_wins(incoming, keys, order_col, first.join(hits, k, "left_anti"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once under the shared checkpoint folder and read back, where a plan refers to it several times."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_ignore(spark: SparkSession, incoming: DataFrame, table_path: str, schema: T.StructType,
                  keys=WAREHOUSE_KEYS, order_col: str = "raw_id") -> int:
    """Append the new rows to the table at `table_path`; returns the inserted count
    (an `observe` metric of the write itself, no second pass). Running it twice inserts 0. The batch is
    staged first, as finding its new rows reads it several times: pages are parsed once."""
    existing = read_or_empty(spark, table_path, schema)
    rows = new_rows(staged(incoming.select(*schema.fieldNames()), "batch"), existing, keys, order_col)
    obs = Observation(f"insert_{uuid.uuid4().hex[:8]}")
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy("source").parquet(table_path)
    return int(obs.get.get("n", 0))


def _missing(ex: AnalysisException) -> bool:
    return ex.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at `path`, or an empty one if nothing is there yet; any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as ex:
        if _missing(ex):
            return spark.createDataFrame([], schema)
        raise


def keyed_update(target: DataFrame, updates: DataFrame, keys=WAREHOUSE_KEYS, set_cols=(),
                 flag: tuple[str, object] | None = None, upsert: bool = False, order_col: str | None = None) -> DataFrame:
    """Set `set_cols` from `updates` on rows whose key matches (a left join, or a full
    join when `upsert`: unmatched updates become new rows). `flag` = (column, value) also set on
    matched rows (e.g. ai_processed = true). Of several updates of a key the last by `order_col` counts,
    ties (or all, without an order) by the greatest row, so that a rerun writes the same."""
    k = list(keys)
    others = [c for c in updates.columns if c not in k]
    last = F.max(F.struct(*([order_col] if order_col else []), *[c for c in others if c != order_col]))
    updates = updates.groupBy(*k).agg(last.alias("_u")).select(*k, *[F.col(f"_u.{c}").alias(c) for c in others])
    upd = updates.select(*k, *[F.col(c).alias(f"_new_{c}") for c in set_cols], F.lit(True).alias("_hit"))
    if upsert:
        extra = [c for c in updates.columns if c not in k and c not in set_cols and c in target.columns]
        upd = updates.select(*k, *[F.col(c).alias(f"_new_{c}") for c in set_cols],
                             *[F.col(c).alias(f"_ins_{c}") for c in extra], F.lit(True).alias("_hit"))
    joined = target.withColumn("_old", F.lit(True)).join(upd, k, "full" if upsert else "left")
    cols = []
    for c in target.columns:
        if c in k:
            cols.append(F.col(c))
        elif c in set_cols:
            cols.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif flag is not None and c == flag[0]:
            cols.append(F.when(F.col("_hit"), F.lit(flag[1])).otherwise(F.col(c)).alias(c))
        elif upsert and f"_ins_{c}" in upd.columns:
            cols.append(F.when(F.col("_old").isNull(), F.col(f"_ins_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


def update_where(df: DataFrame, cond: Column, sets: dict[str, Column], now: datetime | None = None) -> DataFrame:
    """B5 (update_many): `$set` the given columns on every row matching `cond` (NULL = no match).
    `updated_at` is touched on updated rows whenever the table has it (Q23: always, both forms)."""
    hit = F.coalesce(cond, F.lit(False))
    out = df.withColumn("_hit", hit)
    for c, v in sets.items():
        out = out.withColumn(c, F.when(F.col("_hit"), v).otherwise(F.col(c)) if c in df.columns else
                             F.when(F.col("_hit"), v))
    if "updated_at" in df.columns and now is not None:
        out = out.withColumn("updated_at", F.when(F.col("_hit"), F.expr(f"TIMESTAMP_NTZ '{now:%Y-%m-%d %H:%M:%S}'"))
                             .otherwise(F.col("updated_at")))
    return out.drop("_hit")


def update_first(df: DataFrame, cond: Column, sets: dict[str, Column], order: list[Column | str],
                 keys=WAREHOUSE_KEYS, now: datetime | None = None) -> DataFrame:
    """B5 (update_one): `$set` only on the first matching row in `order` (a distributed top-1 picks
    its key; the update is then a keyed match)."""
    first = df.where(cond).orderBy(*order).limit(1).select(*keys).withColumn("_first", F.lit(True))
    marked = df.join(first, list(keys), "left")
    return update_where(marked, F.col("_first"), sets, now).drop("_first").select(*df.columns)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """B6 (delete_many): keep rows where the predicate is not true (NULL counts as not matching)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def delete_first(df: DataFrame, cond: Column, order: list[Column | str], keys=WAREHOUSE_KEYS) -> DataFrame:
    """B6 (delete_one): remove only the first match in `order` (a distributed top-1, then anti join)."""
    first = df.where(cond).orderBy(*order).limit(1).select(*keys)
    return df.join(first, list(keys), "left_anti")


def replace_table(df: DataFrame, base_path: str) -> str:
    """Write `df` as a new version directory under `base_path` and return it. Readers of the old
    version keep working; the caller swaps its pointer only after this returns (H4)."""
    version = f"{base_path.rstrip('/')}/v={datetime.now():%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}"
    df.write.mode("errorifexists").parquet(version)
    return version


def ensure_tables(spark: SparkSession, base: str) -> dict[str, str]:
    """Create the two warehouse tables if missing (parquet partitioned by source, fixed schemas;
    NOT NULL and uniqueness are enforced by the cleaner's rejects and the insert anti join)."""
    paths = {"contents": f"{base.rstrip('/')}/contents", "comments": f"{base.rstrip('/')}/comments"}
    for name, schema in (("contents", S.CONTENTS), ("comments", S.COMMENTS)):
        try:
            spark.read.schema(schema).parquet(paths[name])
        except AnalysisException as ex:
            if not _missing(ex):
                raise
            spark.createDataFrame([], schema).write.mode("ignore").partitionBy("source").parquet(paths[name])
    return paths
