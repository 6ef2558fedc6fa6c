"""J3 (stream): keyed TTL suppression - in event-time order, accept an event when it is forced or at
least TTL after the key's last accepted event (greedy, like an expiring cache; skipped events do not
renew the TTL, forced ones do).

The rule depends on event-time order, so a key's events wait in state until the watermark (the newest
time seen less the declared lateness) has passed them. The state is that of `transformWithState`, for
buckets of keys: a call, a timer and a read of the state cost the same for one key as for many, so their
number is that of the buckets and does not grow with the keys. A bucket holds its waiting events (those of
the last `lateness`) and per key one threshold, both packed. A timer at the earliest waiting event judges,
in order, all that the watermark has passed; thresholds go by a timer once they cannot reject anything any
more, so keys that are gone leave nothing behind. Each judged event is written with its decision.

Events behind the watermark are dropped by the state operator, and those newer than it still wait when
the input ends. `reconcile` judges both in batch, from the archive of all events: per key from its
earliest unjudged event on, seeded with what was accepted before. So the result is what the batch form
gives, however late events come and however files and batches cut the input; lateness decides only
how much the stream has judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from murmur.operators.ttl import ttl_dedupe
from murmur.sources.tables import read_table
from murmur.streaming.common import new_location, ntz_as_instant, read_batches, run_available, write_batch

JUDGED = "user_id long, event_id long, at long, accepted boolean"
ID = ("user_id", "event_id", "ts")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a bucket holds, packed into binary values of at most `CHUNK` of them (times in microseconds).
EVENT = np.dtype([("user_id", "<i8"), ("at", "<i8"), ("event_id", "<i8"), ("force", "?")])
THRESHOLD = np.dtype([("user_id", "<i8"), ("at", "<i8")])
CHUNK = 10_000
BUCKETS = 4096


class Expiry(StatefulProcessor):
    """State of a bucket of keys: their thresholds and the events the watermark has not passed."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.thresholds = handle.getListState("thresholds", "packed binary")
        self.waiting = handle.getListState("waiting", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for pdf in rows:
            events = np.empty(len(pdf), EVENT)
            for c in EVENT.names:
                events[c] = pdf[c].to_numpy()
            self.waiting.appendList(_packed(events))
            first = min(x for x in (first, int(events["at"].min())) if x is not None)
        if first is not None:
            self.handle.registerTimer(_ms(first))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        events = _unpacked(self.waiting, EVENT)
        events = events[np.lexsort((events["force"], events["event_id"], events["at"]))]
        n = int(np.searchsorted(events["at"], passed, "right"))
        due, rest = events[:n], events[n:]
        held = dict(_unpacked(self.thresholds, THRESHOLD).tolist())
        accepted = np.zeros(n, bool)
        for k, (user, at, _, force) in enumerate(due.tolist()):
            if force or at >= held.get(user, at):
                accepted[k] = True
                held[user] = at + self.ttl
        held = np.array([x for x in held.items() if x[1] > passed], THRESHOLD)
        if n:
            _put(self.waiting, rest)
        _put(self.thresholds, held)
        later = [int(x["at"].min()) for x in (rest, held) if len(x)]
        if later:
            self.handle.registerTimer(_ms(min(later)))
        if n:
            yield pd.DataFrame({"user_id": due["user_id"], "event_id": due["event_id"], "at": due["at"], "accepted": accepted})

    def close(self) -> None:
        pass


def _packed(rows: np.ndarray) -> list[tuple[bytes]]:
    return [(rows[k:k + CHUNK].tobytes(),) for k in range(0, len(rows), CHUNK)]


def _unpacked(state, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x, in state.get()), dtype)


def _put(state, rows: np.ndarray) -> None:
    if len(rows):
        state.put(_packed(rows))
    else:
        state.clear()


def _ms(micros: int) -> int:
    """The first millisecond by which this time has passed."""
    return -(-micros // 1000)


def judge_stream(events: DataFrame, out: str, ttl_days: float, lateness_days: float, checkpoint: str | None = None) -> DataFrame:
    """Judge a stream of (user_id, event_id, ts, force) as far as its watermark goes: (user_id, event_id, ts,
    accepted), one folder of `out` for each micro-batch. Rows without a key, id or time are left to `reconcile`."""
    spark = events.sparkSession
    rows = events.where("user_id is not null and event_id is not null and ts is not null").select(
        F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket"), "user_id", "event_id", F.coalesce("force", F.lit(False)).alias("force"),
        F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts")).alias("at"))
    rows = rows.withColumn("seen", F.timestamp_micros("at")).withWatermark("seen", f"{round(lateness_days * 86400)} seconds")
    judged = rows.groupBy("bucket").transformWithStateInPandas(Expiry(round(ttl_days * 86_400_000_000)), JUDGED, "Append", "EventTime")
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # keyed state with timers needs it; a query keeps what it started with
    try:
        run_available(judged, lambda batch, batch_id: write_batch(batch, out, batch_id), "ttl_dedupe", checkpoint)
    finally:
        spark.conf.set(PROVIDER, old) if old else spark.conf.unset(PROVIDER)
    at = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(at AS DECIMAL(20, 0)) / 1000000)")
    return read_batches(spark, out, JUDGED).select("user_id", "event_id", at.alias("ts"), "accepted")


def reconcile(archive: DataFrame, judged: DataFrame, ttl_days: float) -> DataFrame:
    """Accepted events (user_id, ts, event_id) of `archive` (user_id, event_id, ts, force), of which the
    stream has judged some in time order. Rows are compared as a bag, so repeated rows count."""
    both = archive.select(*ID, F.lit(1).alias("n")).unionByName(judged.select(*ID, F.lit(-1).alias("n")))
    open_ = both.where("ts is not null").groupBy(*ID).agg(F.sum("n").alias("n")).where("n > 0")
    start = open_.groupBy(F.col("user_id").alias("_key")).agg(F.min("ts").alias("_start"))
    same = F.col("user_id").eqNullSafe(F.col("_key"))
    kept = judged.where("accepted").join(start, same, "left").where("_start is null or ts < _start")
    rest = archive.join(start, same).where("ts >= _start").drop("_key", "_start")
    carry = kept.where("_start is not null").groupBy("user_id").agg((F.max("ts") + F.expr(f"INTERVAL '{round(ttl_days * 86400)}' SECOND")).alias("_thr"))
    return kept.select("user_id", "ts", "event_id").unionByName(ttl_dedupe(rest, "user_id", "ts", ttl_days, "event_id", "force", carry))


def arriving(events: DataFrame, days: int) -> Iterator[DataFrame]:
    """The events as they would arrive: a folder of files for every `days` days, written one after the
    other, and after each a stream of the files there are now. Rows without a time come first."""
    spark = events.sparkSession
    path = new_location(spark, "tables", "arriving")
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    cuts = [] if span.lo is None else [span.lo + timedelta(days=k) for k in range(days, (span.hi - span.lo).days + 1, days)]
    lit = lambda t: F.lit(t).cast("timestamp_ntz")
    low = [None, *cuts]
    for k, (a, b) in enumerate(zip(low, [*cuts, None])):
        part = events.where(F.lit(True) if a is None else F.col("ts") >= lit(a)).where(F.lit(True) if b is None else F.col("ts").isNull() | (F.col("ts") < lit(b)))
        part.write.parquet(f"{path}/part={k:05d}")
        yield spark.readStream.schema(events.schema).parquet(f"{path}/part=*")


def run_ttl_dedupe(spark: SparkSession, sf_dir: str, ttl_days: float = 7, force: Column | None = None, events: DataFrame | None = None,
                   archive: DataFrame | None = None, lateness_days: float = 5, out: str | None = None, chunk_days: int = 10) -> DataFrame:
    """Accepted events of all input there is now. Without `events`, the events table arrives `chunk_days` days at
    a time, and each arrival is judged by a run that goes on from the state of the one before, in one micro-batch
    whatever its number of files. `archive` is the batch form of the stream's rows; without it a second run of the
    source keeps them."""
    flag = (force if force is not None else F.lit(False)).alias("force")
    arrivals = [events]
    if events is None:
        archive = read_table(spark, sf_dir, "events")
        arrivals = arriving(archive.select("user_id", "event_id", "ts"), chunk_days)
    elif archive is None:
        kept = new_location(spark, "tables", "ttl_archive")
        run_available(events.select(*ID), lambda batch, batch_id: write_batch(batch, kept, batch_id), "ttl_archive")
        archive = read_batches(spark, kept, "user_id long, event_id long, ts timestamp_ntz")
    out, checkpoint = out or new_location(spark, "tables", "ttl_dedupe"), new_location(spark, "checkpoints", "ttl_dedupe")
    for stream in arrivals:
        judged = judge_stream(stream.select(*ID, flag), out, ttl_days, lateness_days, checkpoint)
    return reconcile(archive.select(*ID, flag), judged, ttl_days)
