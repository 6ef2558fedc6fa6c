"""Two-level ranks, limit columns, page metadata plans and staged inserts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.operators import candidates as cd
from murmur.operators import extract as X
from murmur.operators import warehouse as wh


def items(spark, n=400):
    rng = random.Random(1)
    rows = [(rng.choice(["k", "k", "k", "l"]), "s", f"c{i}", None if rng.random() < 0.2 else datetime(2024, 1, 1) + timedelta(hours=rng.randrange(900)), i // 10, i) for i in range(n)]
    return spark.createDataFrame(rows, "keyword string, source string, content_id string, published_ts timestamp_ntz, page long, pos long").repartition(5)


def test_ranks_by_blocks_equal_a_window_over_the_list(spark):
    df = items(spark)
    w = W.partitionBy("keyword", "source").orderBy("pos")
    want = df.withColumn("rank", F.row_number().over(w).cast("long")).withColumn("oldest", F.min("published_ts").over(w.rowsBetween(W.unboundedPreceding, 0)))
    for block in (1, 7, 64, 10_000):
        got, blocks = cd.ranked_in_blocks(df, block=block)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert blocks.agg(F.sum("n")).first()[0] == 400
    assert cd.ranked_in_blocks(df.limit(0))[0].count() == 0


def test_no_window_of_the_ranks_covers_a_whole_list(spark):
    plan = cd.ranked_in_blocks(items(spark))[0]._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "row_number()" in line]
    assert over and all("block" in line.split("windowspecdefinition(")[1].split("pos")[0] for line in over)


def test_limit_column_with_limited_and_unlimited_lists(spark):
    df = items(spark).withColumn("limit", F.when(F.col("keyword") == "k", 13).otherwise(F.lit(None)))
    got = cd.limit_per_list(df, "limit")
    counts = {r.keyword: r["count"] for r in got.groupBy("keyword").count().collect()}
    assert counts == {"k": 13, "l": df.where("keyword = 'l'").count()}
    assert cd.limit_per_list(df.withColumn("limit", F.lit(0)), "limit").count() == 400


def test_page_meta_has_a_small_plan(spark):
    pages = spark.createDataFrame([(1, "<html lang='id'><head><META content='T &amp; U' Property=\"og:title\"><meta name=author content=bare><meta name='date' content=''><title>x</title></head>"),
                                   (2, "<meta name=\"a>b\" content='z'><meta name='author'><title>only</title>"), (3, ""), (4, None)], "ingest_seq long, raw string")
    out = X.page_meta(pages)
    assert len(out._jdf.queryExecution().toString()) < 50_000
    assert [(r.title, r.author, r.lang) for r in out.orderBy("ingest_seq").collect()][:2] == [("T & U", "bare", "id"), ("only", "", "")]


def test_an_insert_computes_its_input_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def parse(batches):
        for b in batches:
            made.add(len(b))
            yield b
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "source_id", "raw_id")])
    df = spark.createDataFrame([("s", str(i % 60), f"{i:03}") for i in range(100)], schema).repartition(3).mapInPandas(parse, schema)
    path = str(tmp_path / "t")
    assert wh.insert_ignore(spark, df, path, schema) == 60 and made.value == 100
    assert wh.insert_ignore(spark, df, path, schema) == 0 and made.value == 200
    assert spark.read.parquet(path).where("source_id = '7'").first().raw_id == "007"
