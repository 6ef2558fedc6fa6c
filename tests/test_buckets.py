"""The bucketed warehouse: only touched files are rewritten, and nothing is seen before the pointer is."""

import uuid

import pytest
from pyspark.sql import functions as F

from murmur.operators import buckets as bk
from murmur.operators import warehouse as wh
from murmur.session import scratch_path

SCHEMA = "source_id string, source string, content string, raw_id long, sentiment string, engine string, confidence double, ai_processed boolean"


def rows_of(spark, ids, content="a text"):
    return spark.createDataFrame([(str(i), f"s{i % 3}", content, i, None, None, None, False) for i in ids], SCHEMA)


@pytest.fixture
def table(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    return bk.BucketTable(spark, scratch_path(spark, f"buckets-{uuid.uuid4().hex}"), schema, buckets=8)


def files(table):
    return set(table.read().inputFiles())


def ids(table):
    return sorted(int(r.source_id) for r in table.read().collect())


def test_insert_ignores_known_keys_and_repeats(spark, table):
    assert table.read().count() == 0
    batch = rows_of(spark, range(50))
    assert table.insert_ignore(batch.union(rows_of(spark, range(10), "again"))) == 50
    before = files(table)
    assert table.insert_ignore(batch) == 0 and files(table) == before
    assert table.insert_ignore(rows_of(spark, range(40, 60))) == 10
    assert before < files(table) and ids(table) == list(range(60))


def test_update_leaves_other_files(spark, table):
    table.insert_ignore(rows_of(spark, range(200)))
    before = files(table)
    new = spark.createDataFrame([("7", "s1", "positive", "bulk", 0.9), ("999", "s0", "negative", "bulk", 0.9)],
                                "source_id string, source string, sentiment string, engine string, confidence double")
    whole = wh.keyed_update(table.read(), new, set_cols=("sentiment", "engine", "confidence"), flag=("ai_processed", True))
    want = sorted(map(str, whole.collect()))
    touched = table.update(new, ("sentiment", "engine", "confidence"), flag=("ai_processed", True))
    assert len(touched) == 1
    gone = before - files(table)
    assert gone and all(f"/bucket={touched[0][0]}/" in f for f in gone)
    assert sorted(map(str, table.read().collect())) == want
    assert table.update(new.where("source_id = '999'"), ("sentiment",)) == []


def test_a_labelling_pass_rewrites_what_was_inserted(spark, table):
    table.insert_ignore(rows_of(spark, range(100)))
    scorer = lambda rows: rows.select("source", "source_id", F.when(F.col("raw_id") % 2 == 0, "neutral").alias("sentiment"),
                                      F.lit("bulk").alias("engine"), F.lit(0.8).alias("confidence"))
    bk.label_pass(table, scorer)
    labelled = {r.source_id: (r.sentiment, r.ai_processed) for r in table.read().collect()}
    assert labelled["4"] == ("neutral", True) and labelled["5"] == (None, False) and len(labelled) == 100
    table.update_where(F.col("sentiment").isNull(), {"sentiment": F.lit("none"), "ai_processed": F.lit(True)})
    before = files(table)
    table.insert_ignore(rows_of(spark, range(100, 103)))
    bk.label_pass(table, scorer)
    assert before < files(table)   # the first hundred rows' files are as they were


def test_a_crash_before_the_pointer_changes_nothing(spark, table, monkeypatch):
    table.insert_ignore(rows_of(spark, range(30)))
    before, seen = files(table), ids(table)

    def crash(self, number, pairs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(bk.BucketTable, "_commit", crash)
        for write in (lambda: table.delete_where(F.col("raw_id") < 20), lambda: table.insert_ignore(rows_of(spark, [77]))):
            with pytest.raises(RuntimeError):
                write()
    assert files(table) == before and ids(table) == seen
    table.delete_where(F.col("raw_id") < 20)
    assert ids(table) == list(range(20, 30))


def test_a_second_writer_of_a_pointer_number_fails(spark, table):
    table.insert_ignore(rows_of(spark, range(5)))
    number, live = table.pairs()
    table.insert_ignore(rows_of(spark, [9]))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table._commit(number, live)
    assert ids(table) == [0, 1, 2, 3, 4, 9]


def test_delete_all_compact_and_odd_keys(spark, table):
    odd = spark.createDataFrame([("a/b=c", "x y/ü", None, 1, None, None, None, None), ("", "007", "t", 2, None, None, None, None)], SCHEMA)
    table.insert_ignore(odd)
    assert sorted((r.source, r.source_id) for r in table.read().collect()) == [("007", ""), ("x y/ü", "a/b=c")]
    for i in range(4):
        table.insert_ignore(rows_of(spark, range(i * 20, i * 20 + 20)))
    seen = ids_all = sorted(r.source_id for r in table.read().collect())
    assert table.compact(max_versions=1)
    live = table.pairs()[1]
    assert len({b for b, _ in live}) == len(live)
    assert sorted(r.source_id for r in table.read().collect()) == seen == ids_all
    assert table.delete_where(F.lit(True)) and table.read().count() == 0
    assert table.insert_ignore(odd) == 2
    with pytest.raises(ValueError):
        table.update_where(F.lit(True), {"source": F.lit("z")})
