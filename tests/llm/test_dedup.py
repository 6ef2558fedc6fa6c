import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import minhash, suffix
from murmur.llm.common import components
from murmur.llm.exact import exact_duplicates
from murmur.llm.minhash import near_duplicates
from murmur.llm.suffix import remove_repeats
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, LONG, clashing, docs, lower, rows


# ---- near duplicates -------------------------------------------------------------------------

def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(ids, texts, k, percent=80):
    sets = [shingles(t, k) for t in texts]
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in itertools.combinations(range(len(ids)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(ids[a]), find(ids[b])
            top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def edited(words, share, rng):
    out = list(words)
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "ONE", "one two", "One  two", "two one", LONG, LONG + " end"]
    for _ in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 120))]
        texts += [edited(base, rng.choice([0, 0.01, 0.03, 0.06, 0.1, 0.2]), rng) for _ in range(9)]
    ids = [7 * i + 3 for i in range(len(texts))]
    want = brute_components(ids, texts, 2)
    got = near_duplicates(clashing(docs(spark, texts, ids)), words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(texts)


def test_near_duplicates_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = table.select("doc_id", "text").collect()
    want = brute_components([r.doc_id for r in given], [r.text for r in given], 5)
    got = near_duplicates(table).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_group_whose_members_meet_only_through_some(spark, monkeypatch):
    """Copies edited one by one: many pairs are below the threshold, blocks are split many times."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = [edited(base, 0.045, rng) for _ in range(70)]
    want = brute_components(list(range(70)), texts, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs(spark, texts), words=2).collect()}
    assert got == want and 1 < len({c for _, c in got.values()}) < 60


def test_repeated_and_null_ids_and_empty_table(spark):
    df = docs(spark, ["a b c", "a b c", "a b c", None], [5, 5, None, 9])
    assert rows(near_duplicates(df, words=2), "doc_id", "component_id", "kept") == sorted([(5, 5, True), (5, 5, True), (9, 9, True), (None, None, False)], key=repr)
    assert near_duplicates(spark.createDataFrame([], DOC)).collect() == []


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 2, 10, 1000):
        s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        assert (minhash.sketches([s], 180) < 2**63).all()
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    x = minhash.sketches([a[:3000], a[1000:]], 400)
    assert abs((x[0] == x[1]).mean() - 0.5) < 0.1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(1, 61)}) == 1 and len({got[i] for i in range(100, 130)}) == 1 and got[1] != got[100]


# ---- exact duplicates ------------------------------------------------------------------------

def brute_exact(ids, texts):
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    out = []
    for i, p in zip(ids, plain):
        group = [(-len(t or ""), j) for j, t, q in zip(ids, texts, plain) if q == p]
        keep = min(group)[1]
        out.append((i, keep, len(group), i == keep, hashlib.sha256(p.encode()).hexdigest()))
    return sorted(out, key=repr)


TEXTS = ["a b", "ab", " a\tb\r\n", "b a", None, "", "  ", "é x", "é x ", LONG, LONG, "ab ", "A b"]


@pytest.mark.parametrize("digest", [None, lambda t: F.substring(t, 1, 1).cast("binary")], ids=["md5", "colliding"])
def test_exact_duplicates_equal_brute_force(spark, digest):
    kw = {"digest": digest} if digest else {}
    got = exact_duplicates(clashing(docs(spark, TEXTS)), **kw)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(list(range(len(TEXTS))), TEXTS)


def test_exact_duplicates_repeated_null_and_empty(spark):
    got = exact_duplicates(docs(spark, ["x", "x", "x"], [4, 4, None]))
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == sorted([(4, 4, 3, True), (4, 4, 3, True), (None, 4, 3, False)], key=repr)
    assert exact_duplicates(spark.createDataFrame([], DOC)).collect() == []


# ---- repeated passages -----------------------------------------------------------------------

def brute_removed(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for x in raw:
        for p in range(len(x) - span + 1):
            seen[x[p:p + span]] = seen.get(x[p:p + span], 0) + 1
    out = []
    for x in raw:
        covered = [False] * len(x)
        for p in range(len(x) - span + 1):
            if seen[x[p:p + span]] > 1:
                covered[p:p + span] = [True] * span
        kept = bytes(c for c, v in zip(x, covered) if not v)
        out.append((len(x), sum(covered), sum(v and not covered[i - 1] if i else v for i, v in enumerate(covered)), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("ab") for _ in range(60))
    noise = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
    texts = [noise() + base[(a := rng.randrange(40)):a + rng.randrange(5, 40)] + noise() for _ in range(25)]
    return texts + ["a" * 50, "", None, texts[0], "é" * 9, "b" * 11, "ab\0ab\0ab\0ab\0ab\0"]


@pytest.mark.parametrize("seed, span, gram, split", [(1, 12, 6, None), (2, 10, 4, ((2, 3), (5, 0))), (3, 9, 5, ((0, 4), (0, 0)))])
def test_remove_repeats_equals_brute_force(spark, monkeypatch, seed, span, gram, split):
    if split:
        monkeypatch.setattr(suffix, "SPLIT", split)
    texts = passages(seed)
    got = remove_repeats(clashing(docs(spark, texts)), span, gram).collect()
    want = brute_removed(texts, span)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(got, key=lambda r: r.doc_id)] == want


def test_remove_repeats_production_span(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(700))
    shared = word()
    texts = [word() + shared[:260] + word(), shared[100:420] + word(), shared[:199] + word(), word(), LONG, LONG[300:5000], None]
    got = remove_repeats(docs(spark, texts)).collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(got, key=lambda r: r.doc_id)] == brute_removed(texts, 200)


def test_remove_repeats_segments_of_long_texts(spark, monkeypatch):
    import murmur.llm.suffix as module
    x = np.frombuffer(LONG.encode()[:20_000], np.uint8)
    whole = [np.concatenate(c) for c in zip(*module.anchors(x, 200, 100))]
    monkeypatch.setattr(module, "SEGMENT", 777)
    parts = [np.concatenate(c) for c in zip(*module.anchors(x, 200, 100))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_remove_repeats_repeated_rows_and_empty_table(spark):
    text = LONG[:500]
    assert rows(remove_repeats(docs(spark, [text, text, "x"], [1, 1, None])), "doc_id", "n_removed", "n_spans") == sorted([(1, 500, 1), (1, 500, 1), (None, 0, 0)], key=repr)
    assert remove_repeats(spark.createDataFrame([], DOC)).collect() == []


def test_remove_repeats_many_copies_of_one_row(spark, monkeypatch):
    """Rows repeated with one id (or none) reach the later stages once, and a text's spans are collected once."""
    unite = suffix._unite
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(400))
    shared = word()
    texts = [shared + word()] * 40 + [word() + shared[20:]] + [word()] * 30
    ids = [7] * 40 + [8] + [None] * 30
    sizes = spark.sparkContext.accumulator(0)

    def counted(batches):
        batches = list(batches)
        sizes.add(sum(len(x) for b in batches for x in b.column(2)))
        yield from unite(iter(batches))
    monkeypatch.setattr(suffix, "_unite", counted)
    got = remove_repeats(docs(spark, texts, ids)).collect()
    want = brute_removed(texts, 200)
    assert sorted(((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)) == sorted((i or 0, *w) for i, w in zip(ids, want))
    assert 0 < sizes.value <= 3 * 800  # not 40 times as many


def test_intervals_of_a_small_suffix_array():
    # suffixes with common prefixes 3, 1, 2, 0: the tree of "longer inside shorter"
    assert sorted(suffix.intervals([0, 3, 1, 2, 0], 1)) == [(1, 0, 3), (2, 2, 3), (3, 0, 1)]
