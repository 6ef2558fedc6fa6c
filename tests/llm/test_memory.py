"""Memory of Python workers: what a task holds is bounded by its chunks, and goes back when the task ends."""

import re
import sys
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from murmur.llm import toxicity
from murmur.llm.common import in_arrow

MODEL = np.full(toxicity.SYMBOLS ** toxicity.ORDER, np.log(toxicity.SYMBOLS), np.float32)
TEXTS = [f"the quick word {i} of a fair text, idiot again " * 30 for i in range(2000)]


def scored(texts):
    shared = SimpleNamespace(value=(MODEL, {"bias": 0.1, "weights": {b"=idiot": 1.0, b"fair": 0.5}}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    return [r for b in toxicity._score(shared)([batch]) for r in b.to_pylist()]


def test_scoring_holds_little_beside_its_batch():
    tracemalloc.start()
    try:
        got = scored(TEXTS)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(got) == len(TEXTS) and peak < 100 << 20


def test_scores_do_not_depend_on_the_chunks(monkeypatch):
    some = ["", None, *TEXTS[:40], "a f a i r one", "an 1d10t"]
    want = scored(some)
    for part in (1, 1000, 1 << 20):
        monkeypatch.setattr(toxicity, "PART", part)
        assert scored(some) == want


def test_readings_forgotten_are_read_again(monkeypatch):
    spans = [f"{a}.{b}.{c}".encode() for a in "abc" for b in "xyz" for c in "mno"] * 2
    restore = toxicity._restorer(MODEL)
    want = [restore(s) for s in spans]
    monkeypatch.setattr(toxicity, "READINGS", 5)
    restore = toxicity._restorer(MODEL)
    assert [restore(s) for s in spans] == want
    assert max(len(c.cell_contents) for c in restore.__closure__ if isinstance(c.cell_contents, dict)) <= 5


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_memory_goes_back_at_the_end_of_a_task(spark):
    def held():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024
    kept, full = [], []

    def task(batches):
        blocks = [np.ones(100_000, np.uint8) for _ in range(3000)]
        kept.append(blocks[-1])  # above all others: what is freed below it stays with the C library
        full.append(held())
        yield from batches
    assert in_arrow(SimpleNamespace(sparkSession=spark, mapInArrow=lambda run, schema: list(run(iter([])))), task, "a long") == []
    assert full[0] - held() > 200
