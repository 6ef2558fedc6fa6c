"""Fill-in-the-middle, collocations and the exact Jaccard join against brute force."""

import gzip
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmur.llm import phrases, setjoin
from murmur.llm import warc
from murmur.llm.fim import SkipList, fill_in_middle, restored, token_widths
from murmur.llm.html import main_text
from murmur.llm.minhash import near_duplicates
from murmur.llm.phrases import MisraGries, collocations
from murmur.llm.queries import ORACLE, QUERIES
from murmur.llm.setjoin import jaccard_components
from murmur.llm.textbytes import chunks
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, LONG, clashing, docs, lower, rows
from tests.llm.test_dedup import brute_components, edited

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [None, "", " ", " \t\n", "a", " a", "a ", " ä b  \n c ", "x<P>y", "<S>", "a <M", "> b <", "P> c", "日本 語 😀 end", LONG, LONG + " \n", "same same", "same same"]


# ---- fill-in-the-middle ----------------------------------------------------------------------

def brute_fim(doc_id, text, rate=50, spm=80, seed=42):
    text = text or ""
    u = TOKEN.findall(text)
    assert "".join(u) == text
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(u), "plain", None, None, text
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if h4 % 100 < spm:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [50, 100])
def test_fim_equals_brute_force(spark, rate):
    ids = [None, *range(1, len(ODD) * 6)]
    texts = (ODD * 6)[:len(ids)]
    df = clashing(docs(spark, texts, ids))
    out = fill_in_middle(df, rate=rate)
    assert rows(out, *out.columns) == sorted((brute_fim(i, t, rate) for i, t in zip(ids, texts)), key=repr)
    back = out.select("doc_id", restored(F.col("output"), F.col("form")).alias("t"))
    assert rows(back, "doc_id", "t") == sorted(((i, t or "") for i, t in zip(ids, texts)), key=repr)


def test_skip_list_reaches_every_rank():
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 40, 3000):
        widths = np.array([rng.randrange(1, 9) for _ in range(n)], np.int64)
        tokens, at = SkipList(widths), np.concatenate(([0], np.cumsum(widths)))
        assert [tokens.reach(r) for r in range(n + 1)] == at.tolist()
    assert len(tokens.lanes) > 3 and all(len(a[0]) > len(b[0]) for a, b in zip(tokens.lanes, tokens.lanes[1:]))
    assert all(u.sum() == 3000 and p.sum() == at[-1] for u, p, _ in tokens.lanes)


def test_tokens_of_documents_in_one_chunk():
    for _, n, buf, starts in chunks(pa.array(ODD), limit=60):
        widths, first = token_widths(buf, starts)
        for i in range(n):
            text = bytes(buf[starts[i]:starts[i + 1] - 1]).decode()
            assert widths[first[i]:first[i + 1]].tolist() == [len(t) for t in TOKEN.findall(text)]


def test_fim_of_an_empty_table_and_repeated_rows(spark):
    assert fill_in_middle(docs(spark, [])).count() == 0
    twice = rows(fill_in_middle(docs(spark, ["a b c d"] * 4, [7, 7, 7, 7])), "form", "output")
    assert len(twice) == 4 and len(set(twice)) == 1


# ---- collocations ----------------------------------------------------------------------------

def brute_phrases(given, threshold, percent=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in given:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        gone = {q[i:i + k] for q, b in cand.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= percent * c[q[i:i + k]]}
        best = []
        for p, a in cand.items():
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out, key=repr)


COLUMNS = "lang rank phrase a l r n score".split()


def phrase_texts():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["der", "Die", "ä", "x-y", "日本", "New", "york"]
    texts = []
    for _ in range(120):
        t = []
        for _ in range(rng.randrange(0, 60)):
            t.append(rng.choice(["New York  City hall", "new\tyork", rng.choice(words), rng.choice(words)]))
            t.append(rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\x0c", "\t", "?!"]))
        texts.append("".join(t))
    return texts + [None, "", " . ,", "\n", "one", LONG, "a b a b " * 40, "a b a b " * 40]


@pytest.mark.parametrize("threshold, top", [(30, 2000), (4, 2000), (4, 7)])
def test_collocations_equal_brute_force(spark, threshold, top):
    texts = phrase_texts()
    langs = [[None, "en", "und", "de", ""][i % 5] for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, g, "s", 0) for i, (t, g) in enumerate(zip(texts, langs))], DOC).repartition(3)
    got = collocations(clashing(df), threshold, top=top)
    want = brute_phrases(list(zip(langs, texts)), threshold, top=top)
    assert rows(got, *COLUMNS) == want and len(want) > 5


def test_collocations_with_small_summaries(spark, monkeypatch):
    """Summaries that must prune, rows handed on early, bitmaps so small that they say yes too often."""
    monkeypatch.setattr(phrases, "COMBINE", 500)
    monkeypatch.setattr(phrases, "BITS", (1 << 15, 1 << 15))
    texts = phrase_texts()
    got = collocations(docs(spark, texts), 30, floor=16)
    assert rows(got, *COLUMNS) == brute_phrases([("en", t) for t in texts], 30)


def test_collocations_of_empty_tables(spark):
    assert collocations(docs(spark, [])).count() == 0
    assert collocations(docs(spark, [None, "", " "])).count() == 0


def test_misra_gries_keeps_every_frequent_key():
    rng = np.random.default_rng(4)
    for seed in range(20):
        keys = np.concatenate((rng.integers(0, 3000, 6000), rng.zipf(1.3, 6000) % 500))
        rng.shuffle(keys)
        summary = MisraGries(30, floor=8, slack=1)
        for part in np.array_split(keys, 40):
            summary.merge([part], [np.ones(len(part), np.int64)])
            assert summary.taken < 30
        k, c = np.unique(keys, return_counts=True)
        assert set(k[c >= 30]) <= set(summary.frequent().tolist())
        assert summary.taken > 0 and len(summary.keys) < len(k)


# ---- exact Jaccard join ----------------------------------------------------------------------

def family_texts(rng, families, members, rates):
    texts = []
    for _ in range(families):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(4, 150))]
        texts += [edited(base, rng.choice(rates), rng) for _ in range(members)]
    return texts


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("words, percent, slots", [(4, 85, 1 << 18), (4, 85, 4), (1, 50, 64), (2, 80, 1 << 10), (4, 100, 16)])
def test_join_equals_brute_force(spark, words, percent, slots):
    rng = random.Random(words + percent)
    texts = [None, "", " \n\t", "one", "ONE", "one two", "One  two", "two one", LONG, LONG + " end", LONG[:-9]]
    texts += family_texts(rng, 12, 9, [0, 0.003, 0.01, 0.02, 0.03, 0.05])
    ids = [7 * i + 3 for i in range(len(texts))]
    got = found(jaccard_components(clashing(docs(spark, texts, ids)), words, percent, slots=slots))
    assert got == brute_components(ids, texts, words, percent)


def test_join_of_sets_that_meet_only_through_some(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK", 4)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(base, 0.02, rng) for _ in range(90)]
    want = brute_components(list(range(90)), texts, 4, 85)
    assert found(jaccard_components(docs(spark, texts))) == want and 1 < len({c for _, c in want.values()}) < 85


def test_join_at_the_threshold(spark):
    """Sets of single words, sizes and overlaps chosen so that the share is exactly at or just under it."""
    texts, ids = [], []
    for k in range(1, 8):
        common = [f"c{k}x{i}" for i in range(17 * k)]
        texts += [" ".join(common + [f"a{k}x{i}" for i in range(3 * k)]), " ".join(common)]  # 17k / 20k
        texts += [" ".join(common[:-1] + [f"b{k}"] * 2 + [f"d{k}x{i}" for i in range(3 * k)])]
    ids = list(range(len(texts)))
    assert found(jaccard_components(docs(spark, texts), 1, 85)) == brute_components(ids, texts, 1, 85)


def test_join_of_rows_that_share_an_id(spark):
    rng = random.Random(8)
    a, b = ([f"{c}{i}" for i in range(80)] for c in "ab")
    texts = [" ".join(a), " ".join(b), edited(a, 0.005, rng), edited(b, 0.005, rng), " ".join(a), "lonely text of no other one"]
    got = rows(jaccard_components(docs(spark, texts, [1, 1, 2, 3, None, 9]), 2, 80), "doc_id", "component_id")
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, None), (9, 9)], key=repr)


def test_join_on_the_given_table_and_an_empty_one(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = table.select("doc_id", "text").collect()
    assert found(QUERIES["op13_setjoin"](spark, SF_SMALL)) == brute_components([r.doc_id for r in given], [r.text for r in given], 4, 85)
    assert jaccard_components(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_fim", "op12_phrases"])
def test_queries_equal_their_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert rows(got, *cols) == sorted(want, key=repr)


# ---- cases that lost rows, links or text -----------------------------------------------------

def test_near_duplicates_of_rows_that_share_an_id(spark):
    rng = random.Random(8)
    a, b = ([f"{c}{i}" for i in range(80)] for c in "ab")
    texts = [" ".join(a), " ".join(b), edited(a, 0.005, rng), edited(b, 0.005, rng), " ".join(a), "lonely text of no other one"]
    got = rows(near_duplicates(docs(spark, texts, [1, 1, 2, 3, None, 9]), 2, 80), "doc_id", "component_id")
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, None), (9, 9)], key=repr)


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    import corpus_pipeline
    from murmur.llm.common import stored
    item = " ".join(f"item{i}" for i in range(20))
    copy = " ".join(f"near{i}" for i in range(200))
    given = [(3, "alpha beta gamma"), (5, "alpha beta gamma"), (5, "unique other text"), (None, "alpha  beta gamma delta"), (None, "alpha beta gamma  delta"), (6, "x " + item), (6, "clean words"),
             (None, "y " + item), (7, copy), (7, "kept words of seven"), (2, copy + " end"), (None, copy + " stop"), (8, "z"), (8, "z")]
    df = docs(spark, [t for _, t in given], [i for i, _ in given])
    for name, part in (("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([("b", item)], "item_id string, text string"))):
        part.write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stored(stage(spark, df, str(tmp_path)), name)
    assert sorted((r.text, r.doc_id) for r in df.collect() if not r.text.startswith("alpha  beta") and not r.text.startswith("alpha beta gamma  ")) == sorted(
        [("alpha beta gamma", 3), ("unique other text", 5), ("clean words", 6), ("kept words of seven", 7), (copy + " end", 2), ("z", 8)])
    assert df.where("doc_id is null").count() == 1


def test_archives_of_several_appends_and_of_one_member(spark, tmp_path):
    warc.register(spark)
    page = lambda a, b: spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(a, b)], "page_id long, url string, html string")
    path = str(tmp_path / "two")
    warc.write_pages(page(0, 5), path)
    warc.write_pages(page(5, 8), path)
    assert spark.read.format("warc").load(path).count() == 8
    one = tmp_path / "one"
    one.mkdir()
    records = [f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {n}\r\n\r\n".encode() + b"x" * n + b"\r\n\r\n" for i, n in enumerate((0, 10, 70_000, 3))]
    (one / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)) + gzip.compress(records[1]))
    (one / "b.warc").write_bytes(b"".join(records))
    for payload in ("true", "false"):
        got = rows(spark.read.format("warc").option("payload", payload).load(str(one)), "record_id", "payload_length")
        assert got == sorted([(f"<urn:page:{i}>", n) for i, n in enumerate((0, 10, 70_000, 3))] * 2 + [("<urn:page:1>", 10)], key=repr)
    cut = tmp_path / "cut"
    cut.mkdir()
    (cut / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)[:-100]))
    with pytest.raises(Exception, match="truncated"):
        spark.read.format("warc").load(str(cut)).count()


STORY = "<p>" + "words of the story go on and on here, " * 8 + "</p>"


@pytest.mark.parametrize("name", ["social-policy content", "search-engine-article", "post side-story", "notice-board entry", "alert-news body", "article related-work"])
def test_class_words_inside_compounds_do_not_drop_the_article(name):
    text = main_text(f"<body><div class='main-menu'><a href=x>menu</a></div><div class='{name}'>{STORY * 3}</div><div class='user-comments'>{STORY}</div></body>")
    assert len(text.split("\n")) == 3 and "menu" not in text


def test_all_parts_of_an_article_stay():
    for html, parts in ((f"<main><article>{STORY}</article><article>{STORY}</article></main>", 2), (f"<article>{STORY}</article><div>{STORY}</div><nav>m</nav>", 2)):
        assert len(main_text(html).split("\n")) == parts


def test_deep_and_unclosed_elements_are_read_in_linear_time():
    for tag in ("b", "div", "p", "thead", "li"):
        start = time.time()
        assert main_text(f"<{tag}>" * 20_000 + "end" + "</i>" * 20_000) == "end"
        assert time.time() - start < 10
