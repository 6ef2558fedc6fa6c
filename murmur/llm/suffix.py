"""Removal of repeated passages with enhanced suffix arrays of anchored suffixes.

A passage of `span` bytes is removed wherever it starts at two or more places of the corpus. Sorting
every suffix of a corpus is not needed for that: of each `span` consecutive bytes the k-gram with the
smallest hash is an anchor, so equal passages have an anchor at the same place in them, about one
position in `span`/4 is one, and only suffixes at anchors that occur again are compared.

1. Anchors of all documents, each with a hash of its k-gram and one of its context, the `span` - k
   bytes before it and the `span` bytes from it on. Counting (with partial aggregation) gives the
   k-grams that occur again; only their anchors go on.
2. Anchors whose whole context occurs again are covered as far as it reaches. For k-grams with
   several contexts one of each is read from its document, and they are grouped by k-gram.
3. Each group's suffixes are sorted; a stack scan over the common prefix lengths of neighbours gives
   the tree of common-prefix intervals. An interval is a repeat to the right of the anchor; its
   members are ordered by what stands to the left, read backwards. Where left contexts differ the
   repeat is left-maximal, and neighbours in that order share the longest left extension there is.
   Left and right extensions that add up to `span` or more cover the anchor's surroundings, for all
   members at once, not just for neighbours in the suffix array.
4. The covered pieces of each document are united and cut out.

K-grams with many contexts are split: a passage around an anchor begins at most `span` - k bytes
before it, so its possible beginnings are dealt into ranges, and for each range contexts are grouped
by the bytes that all passages beginning there share. Beyond a bound on what one task may hold, each
beginning is its own range; what is shared is then the whole passage, and its hash is just counted
(with partial aggregation) and joined back, without groups.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import BROADCAST_ROWS, in_arrow, small, stored
from murmur.llm.textbytes import U64, chunks, hashes, mix, prefix_sums

SPAN, GRAM = 200, 100
SEGMENT = 1 << 20
#: Distinct contexts of a k-gram above which its beginnings are dealt into so many ranges, and above which
#: each of them is counted on its own: no task holds more contexts of a group than the second bound.
SPLIT = ((4096, 8), (1 << 18, 0))
_LOW = U64((1 << 24) - 1)


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive keys, from running minima of blocks both ways."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, U64(2**64 - 1))
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])


def anchors(x: np.ndarray, span: int, gram: int):
    """Yield (places, k-gram hashes, context hashes, bytes of context from the anchor on) of a document's
    anchors, segment by segment."""
    reach, windows = span - gram, len(x) - span + 1
    before = np.empty(0, np.int64)
    for s in range(0, max(windows, 0), SEGMENT):
        e = min(s + SEGMENT, windows)  # passages starting in [s, e)
        lo, hi = max(0, s - reach), min(len(x), e + reach + span)
        sums = prefix_sums(x[lo:hi])
        at = np.arange(s - lo, e - 1 + reach + 1 - lo)
        h = hashes(sums, at, at + gram)
        place = np.unique(window_least((h & ~_LOW) | np.arange(len(h), dtype=U64), reach + 1) & _LOW).astype(np.int64)
        place = place[~np.isin(place + s, before)]
        before = place[-reach - 1:] + s
        a = place + s - lo
        left, right = np.minimum(a + lo, reach), np.minimum(len(x) - a - lo, span)
        context = mix(hashes(sums, a - left, a + right) + left.astype(U64) * U64(1024) + right.astype(U64))
        yield place + s, h[place], context, right


def _anchors(span: int, gram: int):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("place", pa.int64()), ("gram", pa.int64()), ("context", pa.int64()), ("after", pa.int32())])

    def run(batches):
        for batch in batches:
            ids, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at, n, buf, starts in chunks(batch.column(2)):
                rows = []
                for i in range(n):
                    x = buf[starts[i]:starts[i + 1] - 1]
                    rows += [(np.full(len(p), ids[at + i]), np.full(len(p), hs[at + i]), p, g.view(np.int64), c.view(np.int64), r.astype(np.int32)) for p, g, c, r in anchors(x, span, gram)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], schema=schema)
    return run


def ranges(span: int, gram: int, parts: int) -> list[tuple[int, int]]:
    """The numbers of bytes before the anchor at which a passage may begin, as (least, most) ranges."""
    edges = np.linspace(0, span - gram + 1, parts + 1).astype(int)
    return [(int(a), int(b) - 1) for a, b in zip(edges, edges[1:]) if b > a]


def _passages(span: int, gram: int):
    """Documents with their listed anchors -> every passage around each, as a hash, with its beginning."""
    schema = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("gram", pa.int64()), ("context", pa.int64()), ("before", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for r in range(batch.num_rows):
                text = texts[r].as_py()
                for e in batch.column(1)[r].as_py():
                    a, out = e["place"], []
                    for k in range(max(0, a + span - len(text)), min(a, span - gram) + 1):
                        h = hashlib.blake2b(text[a - k:a - k + span], digest_size=16, salt=k.to_bytes(8, "little")).digest()
                        out.append((int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), e["gram"], e["context"], k))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
    return run


def _contexts(span: int, gram: int):
    """Documents with their listed anchors -> contexts, by group."""
    schema = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("gram", pa.int64()), ("context", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("data", pa.binary())])
    reach = span - gram

    def run(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for r in range(batch.num_rows):
                text, out = texts[r].as_py(), []
                for e in batch.column(1)[r].as_py():
                    a, parts = e["place"], e["parts"]
                    left, right = min(a, reach), min(len(text) - a, span)
                    data = bytes(reach - left) + text[a - left:a + right] + bytes(span - right)
                    if parts == 1:
                        out.append((e["gram"], 1, e["gram"], e["context"], left, right, data))
                        continue
                    for least, most in ranges(span, gram, parts):
                        if left >= least and right >= span - most:  # what passages beginning in the range share
                            shared = text[a - least:a + span - most]
                            key = int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=least.to_bytes(8, "little")).digest(), "little", signed=True)
                            out.append((key, parts, e["gram"], e["context"], left, right, data))
                for k in range(0, len(out), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[k:k + 4096]), schema)], schema=schema)
    return run


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading bytes the rows of two matrices share, at most `most`."""
    differ = a != b
    return np.minimum(np.where(differ.any(1), differ.argmax(1), a.shape[1]), most)


def intervals(lcp: list[int], least: int):
    """(common prefix, first, last) of every common-prefix interval of a suffix array with two or more
    members and a prefix of at least `least`; lcp[i] is that of suffixes i - 1 and i (lcp[0] unused)."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now, first = lcp[i] if i < len(lcp) else 0, i - 1
        while stack[-1][0] > now:
            length, first = stack.pop()
            if length >= least:
                yield length, first, i - 1
        if stack[-1][0] < now:
            stack.append((now, first))


def extensions(group: np.ndarray, left: np.ndarray, right: np.ndarray, data: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per context the farthest bytes before and after its anchor that passages repeated in its group
    cover (0, 0 without any). `group` numbers the rows' groups, `data` holds the contexts."""
    reach = span - gram
    ahead, back = np.ascontiguousarray(data[:, reach:]), np.ascontiguousarray(data[:, reach - 1::-1] if reach else data[:, :0])
    order = np.lexsort((ahead.view(f"S{span}").ravel(), group))
    ahead, back, group, left, right = ahead[order], back[order], group[order], left[order], right[order]
    lcp = np.zeros(len(order), np.int64)
    same = group[1:] == group[:-1]
    lcp[1:] = np.where(same, common(ahead[1:], ahead[:-1], np.minimum(right[1:], right[:-1])), 0)
    rank = np.empty(len(order), np.int64)
    rank[np.argsort(back.view(f"S{reach}").ravel(), kind="stable")] = np.arange(len(order))
    one, two, shared = [], [], []
    for length, first, last in intervals(lcp.tolist(), gram):
        if last == first + 1:
            one.append(np.array([first]))
            two.append(np.array([last]))
        else:
            members = np.arange(first, last + 1)
            members = members[np.argsort(rank[members], kind="stable")]
            one.append(members[:-1])
            two.append(members[1:])
        shared.append(np.full(len(one[-1]), length))
    out = np.zeros((2, len(order)), np.int64)
    if one:
        one, two, shared = np.concatenate(one), np.concatenate(two), np.concatenate(shared)
        for at in range(0, len(one), 1 << 16):
            i, j, r = one[at:at + (1 << 16)], two[at:at + (1 << 16)], shared[at:at + (1 << 16)]
            ext = common(back[i], back[j], np.minimum(left[i], left[j]))
            ok = ext + r >= span
            for k in (i[ok], j[ok]):
                np.maximum.at(out[0], k, ext[ok])
                np.maximum.at(out[1], k, r[ok])
    undone = np.empty_like(out)
    undone[:, order] = out
    return undone[0], undone[1]


def _extend(span: int, gram: int, rows_at_once: int = 8192):
    """Contexts sorted by group -> how far each is covered. Groups are worked through several at a time."""
    schema = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("before", pa.int64()), ("after", pa.int64())])

    def done(parts):
        cols = [np.concatenate([p[k] for p in parts]) for k in range(6)]
        key, kind, grams, contexts, left, right = cols
        data = np.concatenate([p[6] for p in parts])
        number = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]))))
        before, after = extensions(number, left, right, data, span, gram)
        hit = np.flatnonzero(after)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in (grams, contexts, before, after)], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                cols = [part.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
                raw = part.column(6)
                data = np.frombuffer(raw.buffers()[2], np.uint8)
                first = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
                width = 2 * span - gram
                held.append((*cols, data[first:first + part.num_rows * width].reshape(-1, width)))
                size += part.num_rows
                if size < rows_at_once:
                    continue
                # all whole groups; the last one may go on
                key, kind = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                others = np.flatnonzero((key != key[-1]) | (kind != kind[-1]))
                if len(others):
                    cut = int(others[-1]) + 1
                    whole = [np.concatenate([h[k] for h in held]) for k in range(7)]
                    yield from done([tuple(c[:cut] for c in whole)])
                    held, size = [tuple(c[cut:] for c in whole)], size - cut
        if size:
            yield from done(held)
    return run


def united(spans: list[tuple[int, int]]) -> list[dict]:
    """The maximal runs that the (start, end) pieces cover together."""
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _unite(batches):
    for batch in batches:
        runs = [united([(e["s"], e["e"]) for e in x.as_py()]) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, _RUNS)], names=["id", "h", "removed"])


def _cut(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("removed", _RUNS)])
    for batch in batches:
        texts, out = batch.column(1).cast(pa.binary()), []
        for r in range(batch.num_rows):
            text, runs = memoryview(texts[r].as_buffer()), batch.column(2)[r].as_py() or []
            kept, at = hashlib.sha256(), 0
            for s in runs:
                kept.update(text[at:s["start"]])
                at = s["end"]
            kept.update(text[at:])
            out.append((batch.column(0)[r].as_py(), len(text), sum(s["end"] - s["start"] for s in runs), len(runs), kept.hexdigest(), runs))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (array of start, end).

    Texts are UTF-8 bytes (null: empty). Every byte covered by a `span`-byte string that also starts
    anywhere else, in the same document or another, is removed; strings are judged on the input.
    Matches never cross documents. Texts shorter than `span` stay. Repeated rows are repeated texts:
    they remove each other. A null id stays null. Other columns are ignored; an empty table gives an
    empty result. Hashes pick candidates; contexts that differ are compared byte by byte, contexts
    told equal agree in two 64-bit hashes.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("h"), "text")
    key = ["id", "h"]
    found = stored(docs.where(F.octet_length("text") >= span).select(*key, "text").transform(in_arrow, _anchors(span, gram), "id long, h long, place long, gram long, context long, after int"), "anchors")
    again = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")).where("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("several"))
    again = stored(again, "grams")
    many = 2 * BROADCAST_ROWS
    repeated = stored(found.join(F.broadcast(again) if again.count() <= many else again, "gram"), "repeated")

    # every distinct context once, with the place of one of its anchors
    contexts = stored(repeated.groupBy("gram", "context").agg(F.count("*").alias("n"), F.first("several").alias("several"), F.first("after").cast("long").alias("after"),
                                                              F.min(F.struct("id", "h", "place")).alias("at")), "contexts")
    several = contexts.where("several")
    crowd = several.groupBy("gram").agg(F.count("*").alias("c")).where(F.col("c") > SPLIT[0][0])
    crowd = stored(crowd.select("gram", F.when(F.col("c") > SPLIT[1][0], SPLIT[1][1]).otherwise(SPLIT[0][1]).alias("parts")), "crowd")
    several = several.join(crowd, "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    # of rows repeated with one id, one stands for all: their contexts are the same
    copies = stored(docs.groupBy(*key).count().where("count > 1").select(*key), "copies")
    single = docs
    if not copies.isEmpty():
        copies = small(copies)
        single = docs.join(copies, key, "left_anti").unionByName(docs.join(copies, key, "left_semi").dropDuplicates(key))

    def placed(rows: DataFrame, few: bool) -> DataFrame:
        """Texts with the anchors of `rows` in them."""
        listed = rows.groupBy("at.id", "at.h").agg(F.collect_list(F.struct(F.col("at.place").alias("place"), "gram", "context", "parts")).alias("anchors"))
        listed = stored(listed, "listed")
        return single.join(F.broadcast(listed) if few else listed, key).select("text", "anchors")
    parts = placed(several.where("parts > 0"), contexts.where("several").count() <= many) \
        .transform(in_arrow, _contexts(span, gram), "part long, kind int, gram long, context long, left int, right int, data binary")
    extended = parts.repartition("part", "kind").sortWithinPartitions("part", "kind").transform(in_arrow, _extend(span, gram), "gram long, context long, before long, after long")
    if crowd.where("parts = 0").limit(1).count():
        passages = stored(placed(several.where("parts = 0"), False).transform(in_arrow, _passages(span, gram), "one long, two long, gram long, context long, before long"), "passages")
        again = passages.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
        extended = extended.union(passages.join(again, ["one", "two"], "left_semi").select("gram", "context", "before", (span - F.col("before")).alias("after")))

    # a context that occurs again covers all it has
    before = F.least(F.col("at.place"), F.lit(span - gram))
    twice = contexts.where("n > 1").select("gram", "context", before.alias("before"), "after").where(F.col("before") + F.col("after") >= span)
    reach = stored(twice.union(extended).groupBy("gram", "context").agg(F.max("before").alias("before"), F.max("after").alias("reach")), "reach")
    covered = repeated.join(reach, ["gram", "context"]).select(*key, F.struct((F.col("place") - F.col("before")).alias("s"), (F.col("place") + F.col("reach")).alias("e")).alias("span"))
    runs = covered.groupBy(*key).agg(F.collect_set("span").alias("spans")).transform(in_arrow, _unite, "id long, h long, removed array<struct<start:bigint,end:bigint>>")
    runs = stored(runs, "runs")
    size = runs.agg(F.sum(F.size("removed"))).first()[0] or 0
    out = docs.join(F.broadcast(runs) if size <= many else runs, key, "left").select("doc_id", "text", "removed")
    return out.transform(in_arrow, _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:bigint,end:bigint>>")
