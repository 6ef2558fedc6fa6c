"""Benchmark decontamination as a prefix-filtered join of item windows with documents.

Every window (consecutive item words, `size` of them or the whole shorter item) must occur in a
document entirely, so its prefix is one necessary token: the word of the window that is rarest in
the corpus. Documents are searched for prefix words only; a match gives a candidate whose place in
the window is known, which bounds the positions (the window must fit into the document), then the
window's hash is compared, then the words themselves.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import in_arrow
from murmur.llm.textbytes import ALNUM, LOWER, U64, chunks, mix, sequence_hashes, spans, word_hashes

#: Words of benchmark text that one pass over the documents searches for (its broadcast is bounded
#: by this); a larger benchmark is worked through in several passes.
BLOCK_WORDS = 1_000_000


def words_of(buf, starts):
    """Lower-cased buffer, word starts and ends, first word of each document, word hashes."""
    low = LOWER[buf]
    a, b = spans(ALNUM[low])
    return low, a, b, np.searchsorted(a, starts), word_hashes(low, a, b)


def _counter(vocabulary):
    """Occurrences in each partition of the words in `vocabulary` (sorted hashes)."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches):
        known = vocabulary.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, buf, starts in chunks(batch.column(0)):
                w = words_of(buf, starts)[4]
                at = np.searchsorted(known, w)
                at[at == len(known)] = 0
                total += np.bincount(at[known[at] == w], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[seen].view(np.int64)), pa.array(total[seen])], schema=schema)
    return run


class Windows:
    """The windows of a block of items, ordered by the hash of their rarest word."""

    def __init__(self, items: list[tuple], size: int):
        self.ids, self.texts, parts = [], [], []
        column = pa.array([t for _, t in items], pa.large_string())
        for at, n, buf, starts in chunks(column):
            low, a, b, first, w = words_of(buf, starts)
            for i in range(n):
                x, y = int(first[i]), int(first[i + 1])
                if y > x:
                    item = len(self.ids)
                    self.ids.append(items[at + i][0])
                    raw = low.tobytes()
                    self.texts.append([raw[p:q] for p, q in zip(a[x:y].tolist(), b[x:y].tolist())])
                    k = min(size, y - x)
                    parts += [(item, p, k, w[x + p:x + p + k]) for p in range(y - x - k + 1)]
        self.parts = parts

    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate([p[3] for p in self.parts])) if self.parts else np.empty(0, U64)

    def ordered(self, known: np.ndarray, counts: np.ndarray) -> dict:
        """Columns over windows, sorted by prefix word; windows whose words never occur are left out."""
        rows = []
        for item, at, k, w in self.parts:
            c = counts[np.searchsorted(known, w)]
            if c.min() > 0:
                j = int(c.argmin())
                rows.append((int(w[j]), j, k, int(sequence_hashes(w, k)[0]), item, at))
        rows.sort()
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (U64, np.int64, np.int64, U64, np.int64, np.int64)
        return dict(zip(("prefix", "place", "length", "hash", "item", "at"), (np.array(c, t) for c, t in zip(cols, kinds))))


def _search(shared, rows_named: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.binary()), ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string()))])

    def merged(spans):
        out = []
        for p, q in sorted(spans):
            if out and p <= out[-1]["b"]:
                out[-1]["b"] = max(out[-1]["b"], q)
            else:
                out.append({"a": p, "b": q})
        return out

    def run(batches):
        ids, texts, win = shared.value
        tokens, first = np.unique(win["prefix"], return_index=True)
        last = np.append(first[1:], len(win["prefix"]))
        lengths = np.unique(win["length"])
        # a bitmap over 24 bits of the word hash lets nearly all words go by in one look-up
        bits = np.zeros(1 << 24, bool)
        bits[(tokens & U64(0xFFFFFF)).astype(np.int64)] = True
        for batch in batches:
            for at, n, buf, starts in chunks(batch.column(1)):
                low, a, b, doc, w = words_of(buf, starts)
                found, which = [[] for _ in range(n)], [set() for _ in range(n)]
                pos = np.flatnonzero(bits[(w & U64(0xFFFFFF)).astype(np.int64)]) if len(tokens) else np.empty(0, np.int64)
                t = np.searchsorted(tokens, w[pos])
                t[t == len(tokens)] = 0
                ok = tokens[t] == w[pos] if len(tokens) else np.empty(0, bool)
                pos, t = pos[ok], t[ok]
                reps = last[t] - first[t]
                window = np.repeat(first[t] - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum()) if len(t) else np.empty(0, np.int64)
                begin = np.repeat(pos, reps) - win["place"][window]
                end = begin + win["length"][window]
                owner = np.searchsorted(doc, np.repeat(pos, reps), "right") - 1
                ok = (begin >= doc[owner]) & (end <= doc[owner + 1])
                window, begin, end, owner = window[ok], begin[ok], end[ok], owner[ok]
                for k in lengths.tolist():
                    sel = np.flatnonzero(win["length"][window] == k)
                    if len(sel):
                        h = np.zeros(len(sel), U64)
                        for i in range(k):
                            h *= U64(0xD1342543DE82EF95)
                            h += w[begin[sel] + i]
                        sel = sel[mix(h + U64(k)) == win["hash"][window[sel]]]
                        for s in sel.tolist():
                            item, p, q = int(win["item"][window[s]]), int(win["at"][window[s]]), int(begin[s])
                            if [low[x:y].tobytes() for x, y in zip(a[q:q + k].tolist(), b[q:q + k].tolist())] == texts[item][p:p + k]:
                                o = int(owner[s])
                                found[o].append((q - int(doc[o]), q - int(doc[o]) + k))
                                which[o].add(ids[item])
                same = [hashlib.blake2b(buf[starts[i]:starts[i + 1]], digest_size=16).digest() if rows_named else None for i in range(n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(same, pa.binary()), pa.array(np.diff(doc), pa.int64()),
                                                  pa.array([merged(f) for f in found], schema.field("spans").type),
                                                  pa.array([sorted(x) for x in which], pa.list_(pa.string()))], schema=schema)
    return run


def _windows(items: DataFrame, id_col: str, text_col: str, words: int, size: int):
    """`Windows` over about `words` words of items each; one partition of the items at a time is fetched."""
    block, held = [], 0
    rows = items.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string")).distinct()
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        held += len(text) // 2 + 1
        if held >= words:
            yield Windows(block, size)
            block, held = [], 0
    yield Windows(block, size)


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    Words are `[0-9a-z and non-ASCII]+` after lower-casing A-Z. A window is `size` consecutive words
    of an item, the whole item if it has fewer, none if it has no words. A document word inside any
    occurrence of a window is hit; contaminated means n_hit > 0 and share * n_hit >= n_words. Null and
    empty texts have no words and are clean. Items are told apart by id; a null item id counts as ''.
    Repeated rows give repeated results (several passes merge rows equal in id and text and repeat
    them again). Other columns are ignored; without items every document is clean.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    passes = []
    blocks = list(_windows(items, item_id, item_text, block_words, size))
    for win in blocks:
        known = win.vocabulary()
        counts = np.zeros(len(known), np.int64)
        if len(known):
            shared = spark.sparkContext.broadcast(known)
            for word, n in docs.select("text").transform(in_arrow, _counter(shared), "word long, n long").groupBy("word").agg(F.sum("n")).collect():
                counts[np.searchsorted(known, U64(word % 2**64))] = n
        data = spark.sparkContext.broadcast((win.ids, win.texts, win.ordered(known, counts)))
        passes.append(docs.transform(in_arrow, _search(data, len(blocks) > 1), "doc_id long, row binary, n_words long, spans array<struct<a long, b long>>, items array<string>"))
    out = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            out = out.union(more)
        out = out.groupBy("doc_id", "row", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), (F.count("*") / len(passes)).cast("int").alias("copies"))
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    # length of the union of the spans: sorted, each adds what lies beyond the furthest end so far
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    add = lambda acc, s: F.struct(F.greatest(acc["end"], s["b"]).alias("end"),
                                  (acc["sum"] + F.greatest(s["b"] - F.greatest(acc["end"], s["a"]), F.lit(0).cast("long"))).alias("sum"))
    hit = F.aggregate(F.array_sort("spans"), zero, add, lambda acc: acc["sum"])
    out = out.select("doc_id", "n_words", hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"), F.array_sort("spans").alias("spans"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans", "items")
