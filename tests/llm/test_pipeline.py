import re

import corpus_pipeline
import pytest
from murmur.llm.common import stored, table
from murmur.llm.toxicity import toxicity
from tests.conftest import SF_MID
from tests.llm.helpers import docs
from tests.llm.test_dedup import brute_components
from tests.llm.test_text import brute_hits


@pytest.fixture(scope="module")
def stages(spark):
    """The table before and after each stage."""
    out = [table(spark, SF_MID, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_MID), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    gone = {r.doc_id for r in toxicity(stages[0], table(spark, SF_MID, "labels")).where("predicted = 1").collect()}
    assert gone and ids(stages[1]) == sorted(set(ids(stages[0])) - gone)


def test_one_of_equal_texts_stays(stages):
    best = {}
    for r in stages[1].collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[key] = min(best.get(key, (0, 0)) if key in best else (-len(r.text), r.doc_id), (-len(r.text), r.doc_id))
    assert ids(stages[2]) == sorted(i for _, i in best.values())


def test_one_of_near_duplicates_stays(stages):
    given = sorted(stages[2].select("doc_id", "text").collect())
    want = brute_components([r.doc_id for r in given], [r.text for r in given], 5)
    assert ids(stages[3]) == sorted(i for i, (_, c) in want.items() if i == c)


def test_contaminated_documents_go(spark, stages):
    given = sorted(stages[3].select("doc_id", "text").collect())
    hits = brute_hits([r.text for r in given], [(r.item_id, r.text) for r in table(spark, SF_MID, "benchmark").collect()])
    assert ids(stages[4]) == [given[k].doc_id for k, *_, bad in hits if not bad]


def test_all_that_is_left_is_packed(stages):
    assert sorted({r.doc_id for r in stages[5].collect()}) == ids(stages[4])
    short = [r[0] for r in stages[5].groupBy("sequence_id").sum("length").select("sum(length)").collect() if r[0] < 4096]
    assert all(n & (n - 1) == 0 for n in short)


def test_awkward_rows(spark, tmp_path):
    df = docs(spark, ["a b", "a  b", None, "", "x", "x", "y"], [1, 2, 3, 4, 5, 5, None])
    for name, rows in (("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stored(stage(spark, df, str(tmp_path)), name)
    assert sorted((r.doc_id or 0, r.text or "") for r in df.collect()) == [(0, "y"), (2, "a  b"), (3, ""), (5, "x")]
