"""A warehouse table whose updates write touched files only.

Layout below `base`:

    v=<version>/bucket=<n>/source=<s>/*.parquet    rows, written once and never changed
    pointers/p=<number>/                           (bucket, v) pairs that make up the table

Rows are dealt to `buckets` buckets by a hash of their keys. Every write makes a new version folder that
holds the buckets it touches and then one new pointer set, which names the live (bucket, v) pairs.
Readers open the pairs of the highest pointer set: until a job has written that set, nothing it did is
seen, and a reader of the older set goes on with files that stay. An insert adds pairs. An update or
delete rewrites the pairs that hold a matching row, so labelling newly inserted rows rewrites what was
inserted, not the buckets' older versions. `compact` joins the versions of a bucket that has many.

The driver handles pairs (buckets times live versions, bounded by `compact`), never rows. One writer at a
time: a second one that commits the same pointer number gets an error and writes nothing that is read.
Versions that no pointer set names are left for the owner of the folder to clear.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.operators import warehouse as wh

#: Live versions of a bucket from which `compact` joins them.
MAX_VERSIONS = 8


@dataclass(frozen=True)
class BucketTable:
    """A bucketed table at `base`. `schema` holds the keys and `source`; `buckets` must not change later."""

    spark: SparkSession
    base: str
    schema: T.StructType
    buckets: int = 256
    keys: tuple = wh.WAREHOUSE_KEYS

    # ------------------------------------------------------------ reads

    def pairs(self) -> tuple[int, list]:
        """The number of the newest pointer set (0: none yet) and its (bucket, v) pairs."""
        try:
            sets = self.spark.read.schema("bucket int, v string, p long").json(f"{self.base}/pointers")
        except AnalysisException as ex:
            if not wh._missing(ex):
                raise
            return 0, []
        newest = sets.agg(F.max("p")).first()[0]
        if newest is None:
            return 0, []
        rows = sets.where(F.col("p") == newest).where("v IS NOT NULL").select("bucket", "v").collect()
        return newest, sorted((r.bucket, r.v) for r in rows)

    def read(self, pairs=None, located: bool = False) -> DataFrame:
        """The table, or the given pairs of it; `located` adds the columns bucket and v."""
        pairs = self.pairs()[1] if pairs is None else pairs
        fields = [f for f in self.schema.fields if f.name != "source"]
        full = T.StructType(fields + [T.StructField("v", T.StringType()), T.StructField("bucket", T.IntegerType()), self.schema["source"]])
        if pairs:
            df = (self.spark.read.schema(full).option("basePath", self.base)
                  .parquet(*[f"{self.base}/v={v}/bucket={b}" for b, v in pairs]))
        else:
            df = self.spark.createDataFrame([], full)
        return df.select(*self.schema.fieldNames(), *(["bucket", "v"] if located else []))

    # ------------------------------------------------------------ writes

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> list:
        """A new version with `rows`; its pairs. The rebalance hint lets the engine join small shuffle
        partitions and split large ones, so a bucket is one file or as many as its size asks for."""
        version = f"n{uuid.uuid4().hex}"
        path = f"{self.base}/v={version}"
        rows = rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket())
        rows.hint("rebalance", "bucket").write.mode("errorifexists").partitionBy("bucket", "source").parquet(path)
        made = wh.read_or_empty(self.spark, path, T.StructType([T.StructField("bucket", T.IntegerType())]))
        return [(r.bucket, version) for r in made.select("bucket").distinct().collect()]

    def _commit(self, number: int, pairs: list) -> None:
        """The new pointer set: one small file that the writer renames into place when it is whole."""
        rows = self.spark.createDataFrame(sorted(pairs) or [(None, None)], "bucket int, v string")
        rows.coalesce(1).write.mode("errorifexists").json(f"{self.base}/pointers/p={number + 1}")

    def insert_ignore(self, incoming: DataFrame, order_col: str = "raw_id") -> int:
        """Append the batch's first rows of keys that the table has not; returns their number. Only
        the batch's buckets are searched for its keys, and no file that is there is rewritten."""
        number, live = self.pairs()
        batch = wh.staged(incoming.select(*self.schema.fieldNames()), "batch")
        asked = {r[0] for r in batch.select(self.bucket()).distinct().collect()}
        there = self.read([p for p in live if p[0] in asked])
        rows = wh.staged(wh.new_rows(batch, there, self.keys, order_col), "new")
        n = rows.count()
        if n:
            self._commit(number, live + self._write(rows))
        return n

    def _rewrite(self, number: int, live: list, touched: list, change) -> list:
        """Write `change(rows of the touched pairs)` as one version that takes the pairs' place; returns
        the touched pairs. Nothing is written when none is touched."""
        if touched:
            gone = set(touched)
            made = self._write(change(self.read(touched)))
            self._commit(number, [p for p in live if p not in gone] + made)
        return touched

    @staticmethod
    def _where(hits: DataFrame) -> list:
        return sorted((r.bucket, r.v) for r in hits.select("bucket", "v").distinct().collect())

    def update(self, updates: DataFrame, set_cols, flag: tuple | None = None, order_col: str | None = None) -> list:
        """`warehouse.keyed_update` on the rows whose key matches; returns the rewritten pairs.

        The updates are staged once. Keys alone decide which pairs hold a match: a semi-join of the key columns
        of the updates' buckets. Updates of keys that the table has not are left out.
        """
        number, live = self.pairs()
        cols = [*self.keys, *set_cols, *([order_col] if order_col and order_col not in set_cols else [])]
        given = wh.staged(updates.select(*cols), "updates")
        asked = {r[0] for r in given.select(self.bucket()).distinct().collect()}
        keyed = self.read([p for p in live if p[0] in asked], located=True).select(*self.keys, "bucket", "v")
        touched = self._where(keyed.join(given.select(*self.keys), list(self.keys), "left_semi"))
        return self._rewrite(number, live, touched, lambda rows: wh.keyed_update(
            rows, given, self.keys, set_cols, flag, order_col=order_col))

    def update_where(self, cond: Column, sets: dict, now=None) -> list:
        """`warehouse.update_where`; only pairs with a matching row are rewritten. Keys must not be set."""
        if set(sets) & {*self.keys, "source"}:
            raise ValueError("the keys of a row decide its bucket and cannot be set")
        number, live = self.pairs()
        touched = self._where(self.read(live, located=True).where(cond))
        return self._rewrite(number, live, touched, lambda rows: wh.update_where(rows, cond, sets, now))

    def delete_where(self, cond: Column) -> list:
        """`warehouse.delete_where`; only pairs with a matching row are rewritten."""
        number, live = self.pairs()
        touched = self._where(self.read(live, located=True).where(cond))
        return self._rewrite(number, live, touched, lambda rows: wh.delete_where(rows, cond))

    def compact(self, max_versions: int = MAX_VERSIONS) -> list:
        """Join the versions of every bucket that has more than `max_versions`; returns the joined pairs."""
        number, live = self.pairs()
        count: dict = {}
        for b, _ in live:
            count[b] = count.get(b, 0) + 1
        return self._rewrite(number, live, [p for p in live if count[p[0]] > max_versions], lambda rows: rows)


def label_pass(table: BucketTable, scorer) -> list:
    """One labelling pass (B4/D5): unprocessed rows -> `scorer` -> labels written into the pairs that hold an
    answered row; returns these. Rows without an answer stay unprocessed (Q16)."""
    from murmur.operators.sentiment import unprocessed
    labels = scorer(unprocessed(table.read()))
    answered = labels.where(F.col("sentiment").isNotNull())
    return table.update(answered, ("sentiment", "engine", "confidence"), flag=("ai_processed", True))
