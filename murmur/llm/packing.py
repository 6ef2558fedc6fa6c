"""Packing of tokenised documents into windows by non-negative least squares over length combinations.

Every task packs the documents of its own input split, in blocks of bounded size, so nothing is
shuffled. Whole windows are cut off long documents first. What is left of each document is counted
in a histogram of lengths in units of window / UNITS; all combinations of up to DEPTH lengths that
fill a window are enumerated, repeat counts x >= 0 that minimise |Ax - histogram| are solved and
rounded down, and documents are dealt to the combinations. The residual documents are poured, cut
where needed, greedily into the gaps that rounding up to units leaves; combinations whose gaps they
cannot fill are taken apart again and join them. The rest fills whole windows, and what a split
leaves at its end becomes sequences whose lengths are powers of two, so that nothing is padded.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from murmur.llm.common import in_arrow

UNITS, DEPTH = 32, 3
BLOCK_TOKENS = 2_000_000
CACHE_WORDS = 1_200_000


def combinations(units: int = UNITS, depth: int = DEPTH) -> np.ndarray:
    """One row per multiset of at most `depth` lengths with sum `units`: how often it has each length 1..units."""
    rows = []
    for k in range(1, depth + 1):
        for c in combinations_with_replacement(range(1, units + 1), k):
            if sum(c) == units:
                rows.append(np.bincount(c, minlength=units + 1)[1:])
    return np.array(rows)


def solve(rows: np.ndarray, histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 with least |rows.T x - histogram|, by cyclic coordinate descent on the normal equations."""
    gram = (rows @ rows.T).astype(float)
    x = np.zeros(len(rows))
    slope = -(rows @ histogram).astype(float)
    for _ in range(rounds):
        before = x.copy()
        for j in range(len(rows)):
            new = max(0.0, x[j] - slope[j] / gram[j, j])
            if new != x[j]:
                slope += gram[:, j] * (new - x[j])
                x[j] = new
        if np.abs(x - before).max() < 1e-3:
            break
    return x


class Packer:
    """Packs (key, length) documents; `emit(key, start, length, sequence, offset)` is called per piece."""

    def __init__(self, window: int, emit):
        self.window, self.emit, self.sequence = window, emit, 0
        self.rows = combinations()
        self.unit = window / UNITS

    def whole(self, key, length: int) -> int:
        """Cut whole windows off; returns where the rest starts."""
        at = 0
        while length - at >= self.window:
            self.emit(key, at, self.window, self.sequence, 0)
            self.sequence += 1
            at += self.window
        return at

    def block(self, rest: list[tuple], last: bool) -> list[tuple]:
        """Pack the (key, start, length) pieces; returns those left for the next block (none if `last`)."""
        bins = defaultdict(list)
        for piece in rest:
            bins[int(np.ceil(piece[2] / self.unit))].append(piece)
        histogram = np.array([len(bins[u]) for u in range(1, UNITS + 1)])
        filled = []
        for row, times in zip(self.rows, np.floor(solve(self.rows, histogram) + 1e-6).astype(int)):
            need = [(u + 1, int(c)) for u, c in enumerate(row) if c]
            for _ in range(times):
                if any(len(bins[u]) < c for u, c in need):
                    break
                filled.append([bins[u].pop() for u, c in need for _ in range(c)])
        pool = [p for u in sorted(bins) for p in bins[u]]  # poured from its end: the longest first
        spare = sum(p[2] for p in pool)
        gaps = [self.window - sum(p[2] for p in f) for f in filled]
        order = sorted(range(len(filled)), key=gaps.__getitem__)
        need = sum(gaps)
        while order and need > spare:  # take apart the combination with the largest gap
            i = order.pop()
            need -= gaps[i]
            spare += self.window - gaps[i]
            pool[:0] = filled[i]
        for i in order:
            self.pour(filled[i], pool, gaps[i])
        while spare - need >= self.window:
            self.pour([], pool, self.window)
            spare -= self.window
        if last:
            left = spare - need
            for bit in reversed(range(left.bit_length())):
                if left >> bit & 1:
                    self.pour([], pool, 1 << bit)
            return []
        return pool

    def pour(self, pieces: list[tuple], pool: list[tuple], gap: int) -> None:
        """Write one sequence: the pieces, then `gap` tokens from the pool's end."""
        at = 0
        for key, start, length in pieces:
            self.emit(key, start, length, self.sequence, at)
            at += length
        while gap:
            key, start, length = pool.pop()
            take = min(length, gap)
            self.emit(key, start, take, self.sequence, at)
            at += take
            gap -= take
            if take < length:
                pool.append((key, start + take, length - take))
        self.sequence += 1


#: Characters of words that are split and looked up piece by piece: printable ASCII and the letters of
#: Latin-1, which composition (NFC) leaves alone and whose lower case is one character.
_LATIN = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def byte_letters() -> list[str]:
    """The letter that byte-level models write for each byte: printable Latin-1 bytes stand for
    themselves, the others take the code points from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (b for b in range(256) if b not in set(shown))
    return [chr(b) for _, b in sorted([(b, b) for b in shown] + [(b, 256 + i) for i, b in enumerate(other)])]


class WordTokens:
    """Little-endian unsigned 32-bit ids of texts. The tokenizer never joins across a blank or a line
    feed, so a text's ids are its words' ids in order; words seen before are looked up, and so are the
    pieces that the tokenizer's own pattern makes of a plain word. All else goes through the tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model, self.known, self.pieces = tokenizer.encode, tokenizer.model, {}, {}
        self.letters, self.pattern = byte_letters(), self.piece_pattern(json.loads(tokenizer.to_str()))

    @staticmethod
    def piece_pattern(spec: dict):
        """The pattern that makes pieces of a lower-cased plain word, if the tokenizer is made that way."""
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        before = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in before] != ["Split", "ByteLevel"] \
                or before[0]["behavior"] != "Removed" or not before[0]["invert"] or before[1]["use_regex"] or before[1]["add_prefix_space"] \
                or spec["model"]["type"] != "BPE" or any(not t["content"].startswith("<|") for t in spec["added_tokens"]):
            return None
        return re.compile(before[0]["pattern"]["Regex"].replace(r"\p{L}", _LATIN).replace(r"\p{N}", "0-9")).findall

    @classmethod
    def of_worker(cls, path: str) -> "WordTokens":
        """One per Python worker and path, kept from task to task."""
        kept = vars(sys.modules["tokenizers"]).setdefault("_word_tokens", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def word(self, word: str) -> bytes:
        if self.pattern is None or "<|" in word or not _PLAIN(word):
            return np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        out = []
        for piece in self.pattern(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                letters = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
                ids = [t.id for t in self.model.tokenize(letters)]
                ids = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def texts(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) + len(self.pieces) > CACHE_WORDS:
            self.known, self.pieces = {}, {}
        for w in set().union(*split).difference(self.known):
            self.known[w] = self.word(w)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def groups(texts: list[str], chars: int = 1 << 18):
    """Runs of consecutive texts of at most about `chars` characters together, with the first's index."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= chars):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def _pack(path: str, end_id: int, window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words = WordTokens.of_worker(path)
        base = TaskContext.get().partitionId() << 40
        docs, out = {}, []  # key -> (doc_id, ids); rows to hand over

        def emit(key, start, length, sequence, offset):
            doc_id, ids = docs[key]
            out.append((doc_id, start, length, ids[4 * start:4 * (start + length)], len(ids) // 4, base + sequence, offset))

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return rows
        packer, rest, held, key, size = Packer(window, emit), [], 0, 0, 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, texts in groups([t or "" for t in batch.column(1).to_pylist()]):
                for doc_id, ids in zip(doc_ids[at:at + len(texts)], words.texts(texts)):
                    key += 1
                    docs[key] = doc_id, ids + end
                    n = len(ids) // 4 + 1
                    cut = packer.whole(key, n)
                    size += cut
                    if cut < n:
                        rest.append((key, cut, n - cut))
                        held += n - cut
                    else:
                        del docs[key]
                    if held >= BLOCK_TOKENS:
                        rest = packer.block(rest, last=False)
                        docs = {k: docs[k] for k, _, _ in rest}
                        held = sum(p[2] for p in rest)
                    if size >= BLOCK_TOKENS // 4 or len(out) > 4096:
                        yield flush()
                        size = 0
        if rest:
            packer.block(rest, last=True)
        if out:
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its text's ids (no special tokens added; null text: empty) and `end_id`. Every id
    lies in exactly one piece; the pieces of a sequence cover it from 0 without gaps, at most `window`
    ids; sequences are full but for each split's last ones, whose lengths are powers of two. Repeated
    rows are packed again each; a null doc_id stays null. Other columns are ignored; an empty table
    gives no pieces. `docs` should be read from files (a stored table), so that a task run again
    sees the same rows in the same order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.transform(in_arrow, _pack(tokenizer, end_id, window), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
