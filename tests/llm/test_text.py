import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from murmur.llm import chat, packing, toxicity, warc
from murmur.llm.decontam import decontaminate
from murmur.llm.html import extract_pages, main_text
from murmur.llm.packing import Packer, WordTokens, pack, solve
from murmur.llm.queries import QUERIES
from murmur.llm.tokens import Counter, count_tokens, sentencepiece_vocabulary
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import DOC, LONG, clashing, docs, lower, rows

# ---- toxicity --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.character_model(spark.read.parquet(f"{SF_MID}/documents.parquet"))


def test_character_model_is_a_distribution(model):
    assert np.allclose(np.exp(-model.reshape(-1, toxicity.SYMBOLS)).sum(1), 1, atol=1e-3)


@pytest.mark.parametrize("span, want", [("1d10t", "idiot"), ("i d i o t", "idiot"), ("s.c.u.m", "scum"), ("stuuuupid", "stupid"), ("l0$er", "loser"), ("m0r0n", "moron"),
                                        ("tr@sh", "trash"), ("i-d-i-0-t", "idiot"), ("plain", "plain")])
def test_decode(model, span, want):
    assert toxicity.decode(span, model) == want


def brute_decode(span, model):
    """All readings of a short span, by recursion over the channel's rules."""
    def readings(i):
        if i == len(span):
            yield "", 0.0
            return
        ch = span[i]
        j = i
        while j < len(span) and span[j] == ch:
            j += 1
        steps = []
        first = i == 0 or span[i - 1] != ch
        if ch.isalpha():
            steps.append((i + 1, ch, 0.0))
            if first and j - i >= 3:
                steps += [(j, ch, toxicity.COST["run"]), (j, ch * 2, toxicity.COST["run"])]
            elif first and j - i == 2:
                steps.append((j, ch, toxicity.COST["pair"]))
        else:
            soft = ch.isspace() or ch in toxicity.MARKS
            steps.append((i + 1, " ", 0.0 if soft else toxicity.COST["symbol"]))
            for a in toxicity.LOOKALIKES.get(ch, ""):
                steps.append((i + 1, a, toxicity.COST["look"]))
                if j - i >= 3:
                    steps.append((j, a, toxicity.COST["look"] + toxicity.COST["run"]))
            if soft and 0 < i < len(span) - 1:
                steps.append((i + 1, "", toxicity.COST["skip"]))
        for to, out, cost in steps:
            for rest, more in readings(to):
                yield out + rest, cost + more

    def total(text, cost):
        codes = [0, 0, 0] + [ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0 for c in text] + [0]
        return cost + sum(float(model[((codes[k] * 28 + codes[k + 1]) * 28 + codes[k + 2]) * 28 + codes[k + 3]]) for k in range(len(codes) - 3))
    return min(total(t, c) for t, c in readings(0)), total


def test_viterbi_finds_the_cheapest_reading(model):
    rng = random.Random(2)
    for _ in range(40):
        span = "".join(rng.choice("aab1330o$ .-té") for _ in range(rng.randrange(1, 8)))
        best, total = brute_decode(span, model)
        costs = [total(t, c) for t, c in _all(span) if t == toxicity.decode(span, model)]
        assert min(costs) == pytest.approx(best, abs=1e-3), span


def _all(span):
    out = []

    def go(i, text, cost):
        if i == len(span):
            out.append((text, cost))
            return
        ch, j = span[i], i
        while j < len(span) and span[j] == ch:
            j += 1
        first, soft = i == 0 or span[i - 1] != ch, ch.isspace() or ch in toxicity.MARKS
        if ch.isalpha():
            go(i + 1, text + ch, cost)
            if first and j - i >= 3:
                go(j, text + ch, cost + toxicity.COST["run"])
                go(j, text + ch * 2, cost + toxicity.COST["run"])
            elif first and j - i == 2:
                go(j, text + ch, cost + toxicity.COST["pair"])
        else:
            go(i + 1, text + " ", cost + (0 if soft else toxicity.COST["symbol"]))
            for a in toxicity.LOOKALIKES.get(ch, ""):
                go(i + 1, text + a, cost + toxicity.COST["look"])
                if j - i >= 3:
                    go(j, text + a, cost + toxicity.COST["look"] + toxicity.COST["run"])
            if soft and 0 < i < len(span) - 1:
                go(i + 1, text, cost + toxicity.COST["skip"])
    go(0, "", 0.0)
    return out


HIDDEN = {"doubled": "iddiot stuupid morron", "run": "iiidiot scuuuum", "marks": "i--d--i--o--t i.-d.-i.-o.-t", "blanks around": "i . d . i . o . t s - c - u - m",
          "split by a mark": "id.iot stu-pid", "split by a blank": "stu pid mo ron", "slash, comma": "i/d/i/o/t s,c,u,m", "euro": "l0s€r", "look-alike": "1d10t m0r0n", "both": "st u p1d iddi0t"}


def _restored(text, model):
    low = np.frombuffer(text.encode() + b" ", np.uint8)
    return {w.decode() for _, w in toxicity._restored(low, np.array([0, len(low)]), toxicity._restorer(model), model)}


@pytest.mark.parametrize("kind", HIDDEN)
def test_every_disguise_reaches_the_lattice(model, kind):
    spans = HIDDEN[kind].split(" ") if kind not in ("blanks around", "split by a blank", "both") else {
        "blanks around": ["i . d . i . o . t", "s - c - u - m"], "split by a blank": ["stu pid", "mo ron"], "both": ["st u p1d", "iddi0t"]}[kind]
    for span in spans:
        best, total = brute_decode(span, model)
        reading = toxicity.decode(span, model)
        assert min(total(t, c) for t, c in _all(span) if t == reading) == pytest.approx(best, abs=1e-3)
        want = set(re.findall(r"[^\W\d_]+", reading)) - set(re.findall(r"[^\W\d_]+", span))
        assert want and want <= _restored(f"the and of {span} the thing", model), span


def test_gate_passes_over_only_plain_readings(model):
    rng = random.Random(5)
    words = ["the", "and", "a", "of", "will", "letter", "see", "i", "to", "it", "é", "stu", "pid"]
    changed = 0
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", ".", ", ", " - ", "/"]) for _ in range(3)).rstrip(" .,-/")
        reading = toxicity.decode(text, model)
        more = set(re.findall(r"[^\W\d_]+", reading)) - set(re.findall(r"[^\W\d_]+", text))
        changed += bool(more)
        assert not more or _restored(text, model), text
    assert changed


def test_scores_read_every_spelling_of_a_mark():
    def hit(text, feature):
        low = np.frombuffer(text.encode() + b" ", np.uint8)
        return bool(toxicity._suspects(low, np.array([0, len(low)]), {feature: toxicity._spellings(feature.removeprefix(b"="))}))
    for spans in HIDDEN.values():
        for word in ("idiot", "stupid", "moron", "scum", "loser"):
            spelled = re.sub(r"(.)\1*", r"\1", spans.translate(str.maketrans("10€", "ioe", " .-/,")))
            assert hit(spans, b"=" + word.encode()) == (word in spelled), (spans, word)
    assert not hit("an idiot idiotic", b"=idiot") and hit("idio t", b"idio") and not hit("god", b"good") and hit("g o o d", b"good")


def test_toxicity_reads_disguises_of_every_kind(spark):
    rng = random.Random(1)
    table = spark.read.parquet(f"{SF_MID}/documents.parquet")
    clean = [r.text[:600] for r in table.join(spark.read.parquet(f"{SF_MID}/labels.parquet").where("toxic = 0"), "doc_id").select("text").collect()]
    texts, marks = [], []
    for i, t in enumerate(clean):
        w = t.split(" ")
        if i % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "stupid"]))
        texts.append(" ".join(w))
        marks.append(int(i % 4 == 0))
    hidden = ["iddiot", "stuupid", "i--d--i--o--t", "i . d . i . o . t", "id.iot", "stu pid", "i/d/i/o/t", "i,d,i,o,t", "stu-pid"]
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")
    by = {r.doc_id: r.predicted for r in toxicity.toxicity(docs(spark, texts + [f"the and of {h} the thing" for h in hidden]), labels).collect()}
    assert [h for k, h in enumerate(hidden) if not by[len(texts) + k]] == []


def test_toxicity_held_out_and_disguised(spark):
    rng = random.Random(1)
    table = spark.read.parquet(f"{SF_MID}/documents.parquet")
    clean = [r.text[:600] for r in table.join(spark.read.parquet(f"{SF_MID}/labels.parquet").where("toxic = 0"), "doc_id").select("text").collect()]
    plain, hidden = ["idiot", "scum", "moron"], ["1d10t", "s.c.u.m", "m0r0n", "iiidiot", "i d i o t"]
    texts, marks = [], []
    for i, t in enumerate(clean):
        w = t.split(" ")
        if i % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(plain))
        texts.append(" ".join(w))
        marks.append(int(i % 4 == 0))
    n = len(texts)
    texts += [f"the and of {h} the thing" for h in hidden] + ["", None, LONG]
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(clashing(docs(spark, texts)), labels).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < n]
    assert len(held) > 20 and sum(r.predicted == marks[r.doc_id] for r in held) >= 0.98 * len(held)
    assert [by[n + k].predicted for k in range(len(hidden))] == [1] * len(hidden)
    assert by[n + 5].score == by[n + 6].score < 0.3 and by[n + 7].predicted == 0


def test_toxicity_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs(spark, ["a", None]), none).collect()} <= {0, 1}
    assert toxicity.toxicity(spark.createDataFrame([], DOC), none).collect() == []
    again = toxicity.toxicity(docs(spark, ["a", "a"], [1, None]), none).collect()
    assert len(again) == 2 and not any(r.held_out for r in again if r.doc_id is None)


# ---- chat formatting -------------------------------------------------------------------------

CHAT = [(1, 0, "user", "hi"), (1, 1, "user", "again </turn>"), (1, 2, "assistant", r"\### Assistant: </turn> ok"), (1, 3, "assistant", ""), (1, 4, "odd: role\n", r"\\\<turn/>"),
        (2, 1, None, None), (2, 0, "assistant", "####  ### x\n</turn>\n"), (2, 0, "assistant", "ends in \\"), (None, None, "user", "né 🙂"), (3, 5, "system", "### "), (3, 5, "system", "### "),
        (4, 0, "assistant", LONG)]


def test_chat_round_trip_and_loss(spark):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("t", "ps", "p", "i", "formatted")})
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert set(got) == {c for c, *_ in CHAT}
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in CHAT if c == conv))
        assert [(x.role, x.text) for x in r.turns] == [(role, text) for _, role, text in turns]
        assert r.loss == "".join(text for _, role, text in turns if role == "assistant")
    assert got[1].formatted.count("### User: ") == 1  # one header for two turns
    assert chat.format_chats(spark.createDataFrame([], df.schema)).collect() == []


# ---- packing ---------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_tokens_equal_the_tokenizer():
    words = WordTokens(PATH)
    odd = ["It's they're I'll 'tis", "ÀÉß ÿ µ ª", "a\x01b \x01 x", "<|endoftext|> a<|startoftext|>b", "é ́x", "ΑΣ Σ", "日本 語", "a1b22 ...!! --", "İ ı ﬁ", "tab\there", "", " ", "\n\nx", "a b c", "'S 'LL don'T"]
    for t, got in zip(odd, words.texts(odd)):
        assert np.frombuffer(got, "<u4").tolist() == words.encode(t, add_special_tokens=False).ids, t


def check_pieces(got, ids):
    """Every id in exactly one piece, sequences gapless from 0, no padding but at powers of two."""
    per, seq = {}, {}
    for r in got:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        per.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(per) == set(ids)
    for d, parts in per.items():
        parts.sort()
        joined, copies = sum((p[1] for p in parts), []), len([p for p in parts if p[0] == 0])
        if copies == 1:
            assert joined == ids[d] and all(p[2] == len(ids[d]) for p in parts)
            assert [p[0] for p in parts] == np.cumsum([0] + [len(p[1]) for p in parts[:-1]]).tolist()
    for parts in seq.values():
        parts.sort()
        end = 0
        for at, n in parts:
            assert at == end
            end += n
        assert end == 4096 or end < 4096 and end & (end - 1) == 0


def test_pack_small_table(spark):
    texts = [None, "", "one", LONG, LONG + LONG, "short text", "a " * 4095, "a " * 4096] + [" ".join(["the"] * k) for k in range(1, 3000, 37)]
    got = pack(clashing(docs(spark, texts)), PATH).collect()
    encode = WordTokens(PATH).encode
    check_pieces(got, {i: encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)})
    assert pack(spark.createDataFrame([], DOC), PATH).collect() == []
    assert sorted((r.doc_id is None, r.doc_tokens) for r in pack(docs(spark, ["x", "x", "x"], [1, 1, None]), PATH).collect() if r.start == 0) == [(False, 2), (False, 2), (True, 2)]


@pytest.mark.parametrize("seed", range(6))
def test_packer_blocks(seed):
    rng = random.Random(seed)
    out, lengths = [], [rng.choice([rng.randrange(1, 4096), rng.randrange(1, 60), 4095, 128, 9000]) for _ in range(rng.randrange(1, 400))]
    packer, rest = Packer(4096, lambda *a: out.append(a)), []
    for k, n in enumerate(lengths):
        at = packer.whole(k, n)
        rest += [(k, at, n - at)] if at < n else []
        if k % 150 == 149:
            rest = packer.block(rest, last=False)
    packer.block(rest, last=True)
    covered = {}
    for key, start, length, _, _ in out:
        covered.setdefault(key, []).append((start, length))
    for k, n in enumerate(lengths):
        end = 0
        for start, length in sorted(covered[k]):
            assert start == end
            end += length
        assert end == n
    used = {}
    for _, _, length, sequence, offset in out:
        used.setdefault(sequence, []).append((offset, length))
    sums = [sum(n for _, n in v) for v in used.values()]
    assert all(s == 4096 or s & (s - 1) == 0 for s in sums) and len([s for s in sums if s < 4096]) <= 12


def test_least_squares_stays_non_negative_and_fits():
    rows_ = packing.combinations(8, 3)
    want = np.array([3, 0, 5, 0, 2, 1, 0, 4, 6, 0][:len(rows_)] + [0] * (len(rows_) - 10), float)[:len(rows_)]
    x = solve(rows_, rows_.T @ want, 5000)
    assert (x >= 0).all() and np.abs(rows_.T @ x - rows_.T @ want).max() < 0.1


# ---- WARC ------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 1200
    data = [(1, "http://a/\r\nx", big), (2, "http://b", big), (7, "http://c", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "é", "é" * 600), (8, "é", "é" * 600), (None, "n", "z" * 2000), (9, "n", "z" * 2000)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("same", "first", "payload", "record_type")}).repartition(3)
    warc.register(spark)
    path = str(tmp_path / "w")
    warc.write_pages(df, path)
    read = spark.read.format("warc").load(path)
    got = {r.record_id: r for r in read.collect()}
    assert len(got) == len(data)
    last = {"<p>" + "x" * 1200: 7, "é" * 600: 8, "z" * 2000: 9}
    for i, _, html in data:
        r = got[f"<urn:page:{'' if i is None else i}>"]
        assert r.payload_digest == "sha1:" + hashlib.sha1((html or "").encode()).hexdigest() and r.payload_length == len((html or "").encode())
        if html in last and i != last[html]:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", f"<urn:page:{last[html]}>", None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, (html or "").encode())
    assert got["<urn:page:1>"].target_uri == "http://a/%0D%0Ax"
    only = read.where("record_type = 'revisit' and refers_to = '<urn:page:7>'")
    assert "PushedFilters" not in only._jdf.queryExecution().toString() or only.count() == 2
    assert sorted(r.record_id for r in only.collect()) == ["<urn:page:1>", "<urn:page:2>"]
    assert {r.payload for r in spark.read.format("warc").option("payload", "false").load(path).collect()} == {None}


def test_warc_pushes_predicates_and_skips_payloads(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan
    path = tmp_path / "x.warc.gz"
    make = lambda kind, k: warc.record({"record_type": kind, "record_id": f"<urn:page:{k}>", "target_uri": "u", "payload": b"y" * 5000, "payload_length": 5000})
    path.write_bytes(b"".join(warc.member(make("response" if k % 2 else "metadata", k)) for k in range(20)))
    reader = warc.WarcReader({"path": str(tmp_path)})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_length",), 3)]))
    assert len(left) == 1 and len(reader.tests) == 1
    parts = reader.partitions()
    assert len(parts) == 1 and sum(b.num_rows for p in parts for b in reader.read(p)) == 10


@pytest.mark.parametrize("packed", ["plain", "members", "foreign"])
def test_warc_kinds_of_archives(tmp_path, packed):
    import gzip
    records = [warc.record({"record_type": "response", "record_id": f"<urn:page:{k}>", "payload": bytes([k]) * (k * 40_000), "payload_length": k * 40_000}) for k in range(5)]
    name = tmp_path / ("a.warc" if packed == "plain" else "a.warc.gz")
    name.write_bytes(b"".join({"plain": bytes, "members": warc.member, "foreign": gzip.compress}[packed](r) for r in records))
    for payloads in (True, False):
        reader = warc.WarcReader({"path": str(tmp_path), "payload": str(payloads)})
        got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["payload_length"], r["payload"]) for r in got] == [(k * 40_000, bytes([k]) * (k * 40_000) if payloads else None) for k in range(5)]


def test_warc_empty(spark, tmp_path):
    warc.register(spark)
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert spark.read.format("warc").load(str(tmp_path / "w")).collect() == []


# ---- token counts ----------------------------------------------------------------------------

def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    blanks = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256)), *vocabulary], unk_id=0, byte_fallback=True))
    library.pre_tokenizer = blanks
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [None, "", " ", "  a", "a  ", "日本語 テスト", "\n\n", "🙂🙂 x", "▁a b", " lead", LONG, "x" * 3000]
    got = sorted(count_tokens(clashing(docs(spark, texts)), vocabulary).collect(), key=lambda r: r.doc_id)
    assert [r.n_tokens for r in got] == [len(library.encode(t or "").ids) for t in texts]
    assert count_tokens(spark.createDataFrame([], DOC), vocabulary).collect() == []
    # ties and unknown runs, without byte fallback
    rng = random.Random(4)
    small = [("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aab", -3.0), ("▁a", -3.0), ("ba", -1.5)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *small], unk_id=0))
    library.pre_tokenizer = blanks
    counter = Counter(small, byte_fallback=False)
    for _ in range(300):
        t = "".join(rng.choice("aabbxy ") for _ in range(rng.randrange(1, 14)))
        assert counter.text(t)[1] == len(library.encode(t).ids), t


# ---- decontamination -------------------------------------------------------------------------

def brute_hits(texts, items, size=13):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = {}
    for i, t in items:
        w = find(lower(t))
        k = min(size, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + k]), set()).add("" if i is None else str(i))
    lengths = {len(k) for k in windows}
    out = []
    for d, t in enumerate(texts):
        w, hit, found = find(lower(t)), set(), set()
        for k in lengths:
            for p in range(len(w) - k + 1):
                if (names := windows.get(tuple(w[p:p + k]))):
                    hit.update(range(p, p + k))
                    found |= names
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [10**6, 40])
def test_decontamination_equals_brute_force(spark, block):
    rng = random.Random(8)
    word = lambda n: [rng.choice("abcdefg") + rng.choice("xyz") for _ in range(n)]
    items = [(10 * i, " ".join(word(rng.choice([1, 2, 5, 13, 14, 40])))) for i in range(25)] + [(7, None), (8, ""), (9, "..."), (11, "Née à 9"), (11, "née, à"), (None, "qq rr ss")]
    texts = [None, "", "!!", "NÉE NÉe née-à 9", "x qq rr ss y", LONG]
    for _ in range(60):
        w = word(rng.randrange(1, 60))
        at = rng.randrange(len(w))
        w[at:at] = rng.choice(items[:25])[1].split() if rng.random() < 0.7 else []
        texts.append(", ".join(w))
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    got = decontaminate(clashing(docs(spark, texts)), df, block_words=block)
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(brute_hits(texts, items), key=repr)


def test_decontamination_without_items_documents_and_with_repeats(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate(docs(spark, ["a b"]), none).collect()] == [(2, 0, False)]
    items = spark.createDataFrame([(1, "a b"), (2, "c d")], "item_id long, text string")
    assert decontaminate(spark.createDataFrame([], DOC), items).collect() == []
    for block in (10**6, 1):
        got = decontaminate(docs(spark, ["a b", "a b", "c d"], [1, 1, None]), items, block_words=block)
        assert rows(got, "doc_id", "n_hit") == sorted([(1, 2), (1, 2), (None, 2)], key=repr)


# ---- HTML ------------------------------------------------------------------------------------

PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>One &amp; two<br>three</p><p><b>Four<br><p>Five</article><footer>f</footer>", "Head\nOne & two three\nFour\nFive"),
    ("<body><div id='sidebar'><p>Side text that is rather long, longer than some.</p></div><div class='content'><p>The main text is here, with a <a href='x'>link</a> in it.</p><p>And a second paragraph of it.</p></div>"
     "<div class='comments'><p>First! I am a reader and have an opinion that is very long indeed.</p></div></body>", "The main text is here, with a link in it.\nAnd a second paragraph of it."),
    ("<body><main><header><a href=/>Home</a></header><section><p>Part one is written here.</p></section><section><p>Part two is written here.</p></section><form><label>Name</label></form></main></body>", "Home\nPart one is written here.\nPart two is written here."),
    ("<body><article><p>Text</p><script>if (a</p>b) x()</script><style>p{}</style><!-- <p>no</p> --><aside>Ad</aside><p>end &lt;b&gt; &#233;&nbsp;x</article></body>", "Text\nend <b> é x"),
    ("<body><div class=cookie-notice>We use cookies</div><article><p>a\n\n  b\tc</p><ul><li>i</li><li>j</ul></article><p>cut <b", "a b c\ni\nj\ncut"),
    ("<body><div class='page with-sidebar'><div class='text'><p>Kept, as the page has a sidebar.</p><p>And more.</p></div><div class='sidebar'>Not kept</div></div></body>", "Kept, as the page has a sidebar.\nAnd more."),
    ("<p>Only a paragraph", "Only a paragraph"), ("plain text", "plain text"), ("", ""), (None, ""), ("<body><nav>m</nav></body>", ""), ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)] + [(0, "again", PAGES[0][0]), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(1))
    got = extract_pages(df).collect()
    assert len(got) == len(PAGES) + 2
    for r in got:
        want = PAGES[r.page_id][1] if r.page_id is not None else ""
        assert (r.text, r.n_chars) == (want, len(want))
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_given_pages_by_another_road():
    """On the given tables the article element can be cut out by patterns alone."""
    import html as h

    import pyarrow.parquet as pq
    for r in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert main_text(r["html"]) == "\n".join(b for b in blocks if b)


# ---- the registered queries ------------------------------------------------------------------

def test_packing_query_on_the_given_table(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    encode = WordTokens(PATH).encode
    for r in QUERIES["op5_packing"](spark, SF_SMALL).collect():
        ids = encode(given[r.doc_id], add_special_tokens=False).ids + [2]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
