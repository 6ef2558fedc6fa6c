"""Fill-in-the-middle: texts cut at two token ranks found in an indexable skip list, parts reordered.

The tokens of a text are the nodes of a skip list's lowest lane. Every express lane above holds the
nodes that a hash of their place promotes (one in four), each with two accumulated widths: how many
tokens it spans and how many code points. A rank is reached from the top: walk on while the next
node's token width still fits, add up both widths, drop a lane. At the bottom the token count is the
rank itself and the code-point sum is the place to cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import in_arrow
from murmur.llm.textbytes import BLANKS, U64, chunks, mix, spans

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of documents that are transformed, and of those the share with the suffix first.
RATE, SPM_RATE = 50, 80
SEED = 42
_PROMOTED = U64(2**64 // 4)


def token_widths(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point widths of the tokens of a chunk's documents, and each document's first token. A
    token is a word with the blanks before it, or the blanks after the last word."""
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    a, ends = spans(~BLANKS[buf])
    first = np.searchsorted(a, starts)
    close = starts[1:] - 1  # without the blank that chunks() adds
    last = np.where(first[1:] > first[:-1], ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, starts[:-1])
    tail = close > last
    ends = np.insert(ends, first[1:][tail], close[tail])
    first = first + np.concatenate(([0], np.cumsum(tail)))
    begin = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    used = first[1:] > first[:-1]
    begin[first[:-1][used]] = starts[:-1][used]
    return points[ends] - points[begin], first


class SkipList:
    """An indexable skip list over the code-point widths of tokens."""

    def __init__(self, widths: np.ndarray):
        units, points, down = np.ones(len(widths), np.int64), widths, None
        self.lanes = [(units, points, down)]
        while len(units) > 4:
            promoted = mix(np.arange(len(units), dtype=U64) + U64(len(self.lanes) << 40)) < _PROMOTED
            promoted[0] = True
            down = np.flatnonzero(promoted)
            if len(down) == len(units):
                break
            units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
            self.lanes.append((units, points, down))

    def reach(self, rank: int) -> int:
        """Code points before the token of that rank (all of them where rank is the token count)."""
        done = chars = node = 0
        for units, points, down in reversed(self.lanes):
            while node < len(units) and done + units[node] <= rank:
                done += units[node]
                chars += points[node]
                node += 1
            if down is not None:
                node = down[node] if node < len(units) else len(self.lanes[0][0])
        return int(chars)


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def _transform(rate: int, spm_rate: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string())])

    def one(doc_id, text, widths):
        n = len(widths)
        cut1, cut2, chance, order = _draws(doc_id, seed)
        if not text or chance % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            return doc_id, n, "plain", None, None, text
        tokens = SkipList(widths)
        lo, hi = sorted((cut1 % (n + 1), cut2 % (n + 1)))
        p, m = tokens.reach(lo), tokens.reach(hi)
        prefix, middle, suffix = text[:p], text[p:m], text[m:]
        if order % 100 < spm_rate:
            return doc_id, n, "spm", p, m - p, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return doc_id, n, "psm", p, m - p, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    def run(batches):
        for batch in batches:
            for at, n, buf, starts in chunks(batch.column(1)):
                widths, first = token_widths(buf, starts)
                ids, texts = (batch.column(c).slice(at, n).to_pylist() for c in (0, 1))
                out = [one(ids[i], texts[i] or "", widths[first[i]:first[i + 1]]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    The id alone decides whether and where a text is cut, so repeated rows give equal outputs and no
    run depends on the partitioning. Null counts as empty; empty texts and those that hold one of
    the three marks stay plain (output is the text, lengths are null). Texts of blanks only are one
    token. A null id draws from the seed alone. Cuts may fall on 0 or on the last rank, so any part
    may be empty. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.transform(in_arrow, _transform(rate, spm_rate, seed), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of `fill_in_middle` was made from. No text part holds a mark, and a
    mark starts only where it was written, so each occurs once."""
    before = lambda c, mark: F.substring_index(c, mark, 1)
    after = lambda c, mark: F.substring_index(c, mark, -1)
    psm = F.concat(after(before(output, SUFFIX), PREFIX), after(output, MIDDLE), after(before(output, MIDDLE), SUFFIX))
    spm = F.concat(after(before(output, MIDDLE), PREFIX), after(output, MIDDLE), after(before(output, PREFIX), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
