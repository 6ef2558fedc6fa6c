"""J3 (batch): keyed TTL suppression by pointer jumping.

In (time, tiebreak) order a key's event is accepted when it is forced or at least the TTL after the
key's last accepted event (greedy, as an expiring cache with a `force` override: skipped events do
not renew the TTL, forced ones do). What an accepted event lets in next depends on that event alone:
the key's first event at or after its time + TTL. So every event points there, and the accepted
events are those reached from a key's start or from a forced event. Doubling the pointers reaches
them in log2(longest unforced chain) rounds: twelve for a TTL of an hour over a month.

No key is gathered in one task. Events ("arrivals") and the times at which they let the next one in
("expiries") form one sequence in the order of (key, time), cut into ranges of it by sampling, so a
hot key spans many tasks. Both kinds keep the same order among themselves, as all expiries lie one TTL
later. The n-th expiry therefore belongs to the n-th arrival, and points to the arrival whose number
is that of the arrivals before it: running counts, done as a prefix scan of blocks, replace the join
on time. Each key starts with a forced arrival before all time, which is left out of the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.session import scratch_path

#: A block of the prefix scan has 2^12 rows; row numbers have 33 bits below the partition's number.
BLOCK_BITS, PARTITION_BITS = 12, 33
BEFORE_ALL = -(1 << 62)
COUNTS = ("arrived", "expired", "forced_arrived", "forced_expired")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"ttl_dedupe/{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _micros(c: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c.cast("timestamp_ntz"))


def _sequence(events: DataFrame, ttl: int) -> DataFrame:
    """Arrivals and expiries of events (key, ts, tiebreak, t, force) in the order of (key, time), numbered in that
    order (`id`), stored."""
    none = lambda c: F.lit(None).cast(events.schema[c].dataType).alias(c)
    starts = events.select("key").distinct().select(
        "key", none("ts"), none("tiebreak"), F.lit(BEFORE_ALL).cast("long").alias("t"), F.lit(True).alias("force"))
    rows = events.unionByName(starts).withColumn("arrival", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("t", F.when(F.col("arrival") == 1, F.col("t")).otherwise(F.col("t") + F.lit(ttl)))
    order = [F.col("key"), F.col("t"), F.col("arrival"), F.col("tiebreak"), F.col("force").desc()]
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return _stored(rows.withColumn("id", F.monotonically_increasing_id()), "sequence")


def _counted(sequence: DataFrame) -> DataFrame:
    """`sequence` with running counts, each row included: within blocks, over the blocks of a partition and
    over the partitions (one row each)."""
    arrival, force = F.col("arrival"), F.col("force").cast("int")
    rows = sequence.withColumn("block", F.shiftright("id", BLOCK_BITS)).withColumns(dict(zip(COUNTS, (
        arrival, 1 - arrival, arrival * force, (1 - arrival) * force))))
    blocks = rows.groupBy("block").agg(*[F.sum(c).alias(c) for c in COUNTS]) \
        .withColumn("part", F.shiftright("block", PARTITION_BITS - BLOCK_BITS))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(*[F.sum(c).alias(c) for c in COUNTS])
    parts = parts.select("part", *[F.coalesce(F.sum(c).over(before(Window.orderBy("part"))), F.lit(0)).alias(f"{c}_0") for c in COUNTS])
    blocks = blocks.select("block", "part", *[F.coalesce(F.sum(c).over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0)).alias(f"{c}_1")
                                              for c in COUNTS])
    blocks = blocks.join(parts, "part").select("block", *[(F.col(f"{c}_0") + F.col(f"{c}_1")).alias(f"{c}_before") for c in COUNTS])
    inside = Window.partitionBy("block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({c: F.sum(c).over(inside) for c in COUNTS}).join(blocks, "block")
    return rows.withColumns({c: F.col(c) + F.col(f"{c}_before") for c in COUNTS}).drop(*[f"{c}_before" for c in COUNTS])


def _reached(starts: DataFrame, pointers: DataFrame) -> tuple[DataFrame, int]:
    """The nodes on the paths from `starts` (node) along `pointers` (node, next), and the rounds taken. After
    round r all nodes fewer than 2^r steps away are found, and pointers are 2^r steps long."""
    found, rounds = starts, 0
    while True:
        rounds += 1
        new = found.join(pointers, "node").select(F.col("next").alias("node")).distinct().join(found, "node", "left_anti")
        new = _stored(new, "reached")
        if new.isEmpty():
            return found, rounds
        found = found.union(new)
        far = pointers.select(F.col("node").alias("next"), F.col("next").alias("far"))
        pointers = _stored(pointers.join(far, "next").select("node", F.col("far").alias("next")), "pointers")


def ttl_dedupe(events: DataFrame, key: str, ts: str, ttl_days: float, tiebreak: str, force_col: str | None = None,
               carry: DataFrame | None = None) -> DataFrame:
    """The accepted events: (key, ts, tiebreak). `carry` (key, _thr) holds for some keys the time from which an
    unforced event is accepted, as earlier input left it.

    A null key is a key of its own; events without a time are left out; a null `force_col` is not forced. Of
    rows equal in key, time and tiebreak the forced ones are all accepted and come first. Other columns are
    ignored; an empty input gives an empty result.
    """
    return ttl_chain(events, key, ts, ttl_days, tiebreak, force_col, carry)[0]


def ttl_chain(events: DataFrame, key: str, ts: str, ttl_days: float, tiebreak: str, force_col: str | None = None,
              carry: DataFrame | None = None) -> tuple[DataFrame, int]:
    """`ttl_dedupe` and the number of doubling rounds."""
    ttl = round(ttl_days * 86_400_000_000)
    if ttl <= 0:
        raise ValueError("ttl_days must be positive")
    forced = F.coalesce(F.col(force_col), F.lit(False)) if force_col else F.lit(False)
    rows = events.where(F.col(ts).isNotNull()).select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(tiebreak).alias("tiebreak"),
                                                      _micros(F.col(ts)).alias("t"), forced.alias("force"))
    if carry is not None:  # nothing unforced before the threshold can be accepted, and forced events only move it on
        rows = rows.join(carry.select(F.col(key).alias("_key"), "_thr"), F.col("key").eqNullSafe(F.col("_key")), "left") \
            .where(F.col("force") | F.col("_thr").isNull() | (F.col("ts") >= F.col("_thr"))).drop("_key", "_thr")
    placed = _stored(_counted(_sequence(rows, ttl)), "placed")
    arrivals = placed.where("arrival = 1").select((F.col("arrived") - 1).alias("node"), "key", "ts", "tiebreak", "force")
    # an expiry with a forced arrival between its own and the next one lets nothing in: that arrival takes over
    pointers = placed.where("arrival = 0 and forced_arrived = forced_expired").select((F.col("expired") - 1).alias("node"), F.col("arrived").alias("next"))
    found, rounds = _reached(arrivals.where("force").select("node"), pointers)
    out = arrivals.where("ts is not null").join(found, "node", "left_semi")
    return out.select(F.col("key").alias(key), F.col("ts").alias(ts), F.col("tiebreak").alias(tiebreak)), rounds
