"""Phrases that occur together: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

First pass: n-grams are counted as 64-bit hashes, combined in each task, dealt out by hash, and every
hash partition keeps one Misra-Gries summary. A summary never has fewer counters than the partition's
mass so far divided by the threshold. Pruning takes the same amount off all counters; the sum of what
was taken off is kept below the threshold (otherwise the summary grows instead), so every n-gram that
reaches the threshold survives. The pass goes by length: an n-gram is only counted if the shorter ones
inside it survived, which a bitmap of bounded size tells (a false yes costs work, nothing else).

Second pass: the n-grams that the bitmaps let through are counted exactly, as strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from murmur.llm.common import in_arrow, stored
from murmur.llm.textbytes import LOWER, U64, chunks, mix, sequence_hashes, spans, word_hashes

LONGEST = 4
#: Counters of a summary: at least FLOOR, and SLACK times the mass divided by the threshold.
FLOOR, SLACK = 1 << 18, 4
#: Rows that a task combines before it hands them on.
COMBINE = 1 << 20
#: Bytes of text for one hash partition.
PART_BYTES = 64 << 20
#: Bits of a bitmap: 16 for each survivor, within these bounds (32 MB at most).
BITS = 1 << 20, 1 << 28

_END = np.zeros(256, bool)  # ends a piece: . , ; : ! ? and \x0A-\x0D
_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _END.copy()
_APART[[0x20, 0x09]] = True


def _words(batches):
    """(lang, lower-cased buffer, word starts and ends, piece number of each word) of chunks of texts
    in one language; batches hold lang and text."""
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        for lang in pc.unique(langs).to_pylist():
            for _, _, buf, starts in chunks(texts.filter(pc.equal(langs, lang))):
                buf = LOWER[buf]
                buf[starts[1:] - 1] = 0x0A  # no piece goes on in the next document
                a, b = spans(~_APART[buf])
                yield lang, buf, a, b, np.cumsum(_END[buf])[a]


def _lang_key(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode() + b" ", np.uint8)
    return word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes are set in a bitmap (bytes)."""
    at = hashes & U64(8 * len(bits) - 1)
    return (bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1


def grams(words: np.ndarray, piece: np.ndarray, lang: str, size: int, kept: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the n-grams of `size` words within pieces whose shorter parts survived
    (as far as `kept` tells, by length)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    key = _lang_key(lang)
    at = np.flatnonzero(piece[:n] == piece[size - 1:])
    for k in sorted(kept):
        if k < size:
            ok = has(kept[k], mix(sequence_hashes(words, k) + key))
            for j in range(size - k + 1):
                at = at[ok[at + j]]
    return at, mix(sequence_hashes(words, size)[at] + key)


def _combined(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(first) else c


_COUNTS = pa.schema([("h", pa.int64()), ("c", pa.int64())])


def _rows(k: np.ndarray, c: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], schema=_COUNTS)


def _hash_counts(sizes: tuple[int, ...], shared):
    """Combined (hash, count) of the n-grams of these sizes."""
    def run(batches):
        kept = shared.value if shared else {}
        keys, counts, held = [], [], 0
        for lang, buf, a, b, piece in _words(batches):
            words = word_hashes(buf, a, b)
            for size in sizes:
                _, h = grams(words, piece, lang, size, kept)
                k, c = np.unique(h, return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
            if held > COMBINE:
                k, c = _combined(keys, counts)
                if 2 * len(k) > COMBINE:
                    yield _rows(k, c)
                    k, c = k[:0], c[:0]
                keys, counts, held = [k], [c], len(k)
        if held:
            yield _rows(*_combined(keys, counts))
    return run


class MisraGries:
    """A summary of (key, count) streams: no key of `threshold` or more is lost."""

    def __init__(self, threshold: int, floor: int = FLOOR, slack: int = SLACK):
        self.threshold, self.floor, self.slack = threshold, floor, slack
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.mass = self.taken = 0

    def merge(self, keys: list, counts: list) -> None:
        self.mass += int(sum(c.sum() for c in counts))
        self.keys, self.counts = _combined([self.keys, *keys], [self.counts, *counts])
        over = len(self.keys) - max(self.floor, self.slack * (self.mass // self.threshold + 1))
        if over > 0:
            least = int(np.partition(self.counts, over - 1)[over - 1])
            if self.taken + least < self.threshold:
                self.taken += least
                stay = self.counts > least
                self.keys, self.counts = self.keys[stay], self.counts[stay] - least

    def frequent(self) -> np.ndarray:
        """All keys that may reach the threshold: a true count is at most what is left plus what was taken."""
        return self.keys[self.counts + self.taken >= self.threshold]


def _summary(threshold: int, floor: int):
    schema = pa.schema([("h", pa.int64())])

    def run(batches):
        summary, keys, counts, held = MisraGries(threshold, floor), [], [], 0
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            counts.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= floor:
                summary.merge(keys, counts)
                keys, counts, held = [], [], 0
        if keys:
            summary.merge(keys, counts)
        found = summary.frequent()
        for at in range(0, len(found), COMBINE):
            yield pa.RecordBatch.from_arrays([pa.array(found[at:at + COMBINE])], schema=schema)
    return run


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap (bytes) of a stored table's column h, with 16 bits for each of its rows as far as BITS allows."""
    bits, rows = BITS[0], hashes.count()
    while bits < min(16 * rows, BITS[1]):
        bits *= 2
    place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1
    blocks = hashes.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.collect():  # at most 8,192 blocks of 4 KB
        out[4096 * (r.block - 1):4096 * r.block] = np.frombuffer(r.bits, np.uint8)
    return out


def survivors(texts: DataFrame, sizes: tuple[int, ...], threshold: int, kept: dict[int, np.ndarray], parts: int, floor: int = FLOOR) -> np.ndarray:
    """The bitmap of the n-grams of these sizes that may occur `threshold` times."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(kept) if kept else None
    left = stored(texts.transform(in_arrow, _hash_counts(sizes, shared), "h long, c long").repartition(parts, "h")
                  .transform(in_arrow, _summary(threshold, floor), "h long"), "survivors")
    return bitmap(left)


def _joined(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them: buffer, starts, ends."""
    size = b - a
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1])) if len(a) else a
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    src = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(start, size) + src] = buf[np.repeat(a, size) + src]
    return out, start, start + size


def _slices(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    size = b - a
    ends = np.cumsum(size)
    src = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    data = buf[np.repeat(a, size) + src]
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(a), pa.py_buffer(offsets), pa.py_buffer(data))


def _phrase_counts(shared):
    """(lang, words, phrase, count) of what the bitmaps let through, combined by chunk; words = 0 has the number of all words."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("c", pa.int64())])

    def rows(lang, size, phrases, counts):
        n = len(phrases)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), phrases.cast(pa.string()), counts], schema=schema)

    def run(batches):
        kept = shared.value
        for lang, buf, a, b, piece in _words(batches):
            if not len(a):
                continue
            words = word_hashes(buf, a, b)
            buf, a, b = _joined(buf, a, b)
            yield rows(lang, 0, pa.array([""]), pa.array([len(a)]))
            for size in range(1, LONGEST + 1):
                at, h = grams(words, piece, lang, size, kept)
                at = at[has(kept[size], h)]
                for k in range(0, len(at), 1 << 17):
                    part = at[k:k + (1 << 17)]
                    found = pc.value_counts(_slices(buf, a[part], b[part + size - 1]))
                    yield rows(lang, size, found.field(0), found.field(1))
    return run


def frequent_phrases(docs: DataFrame, threshold: int = 30, text_col: str = "text", lang_col: str = "lang", floor: int = FLOOR) -> DataFrame:
    """(lang, words, phrase, f): exact counts of all phrases of one to four words that occur at least
    `threshold` times in their language, and under words = 0 the number of all words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    kept: dict[int, np.ndarray] = {}
    for sizes in ((1,), (2,), (3, 4)):
        found = survivors(texts, sizes, threshold, kept, parts, floor)
        kept |= {k: found for k in sizes}
    counted = texts.transform(in_arrow, _phrase_counts(spark.sparkContext.broadcast(kept)), "lang string, words int, phrase string, c long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f")).where((F.col("f") >= threshold) | (F.col("words") == 0))


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, threshold: int = 30, percent: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang", floor: int = FLOOR) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased (A-Z) and stand between blanks, phrases within pieces that end at . , ; : ! ?
    or a line break. A phrase of two to four words with a >= threshold occurrences scores
    floor(2000000 a / (l + r)) at its worst cut into two parts with l and r occurrences (ties: the
    first cut). It is dropped if it lies inside a longer one that occurs at least `percent` per cent
    as often. Order: score, then a, both descending, then the phrase by bytes. n is the number of words
    of the language. Null texts count as empty, a null language is `und`; repeated rows count each; other
    columns are ignored; an empty table gives an empty result.
    """
    counts = stored(frequent_phrases(docs, threshold, text_col, lang_col, floor), "phrases")
    known = counts.where("words > 0").select("lang", "phrase", "f")
    long = counts.where("words > 1").withColumn("w", F.split("phrase", " ")).select("lang", "phrase", "words", "w", F.col("f").alias("a"))
    part = lambda at, n: F.array_join(F.slice("w", at, n), " ")

    cuts = long.select("lang", "phrase", "words", "w", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    side = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumn("up", F.lit(2000000).cast("decimal(7,0)") * _wide(F.col("a"))).withColumn("down", _wide(F.col("l")) + _wide(F.col("r")))
    worst = cuts.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("m")) \
        .select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")

    spans_ = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice("w", at, n), " "))))
    inside = long.where("words > 2").select("lang", F.explode(spans_).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = worst.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * percent))

    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = left.select("lang", "phrase", "a", "l", "r", "score", rank.alias("rank")).where(F.col("rank") <= top)
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
