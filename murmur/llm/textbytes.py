"""UTF-8 byte views of Arrow text columns: bounded chunks, word spans and 64-bit word hashes.

Every separator used by the operators is ASCII, so words can be found on bytes; documents are
joined into one buffer with a blank after each, at most `CHUNK` bytes at a time (a longer document
makes a chunk of its own), and all work on a chunk is vectorised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15  # base of the rolling hash; odd, so it has an inverse modulo 2**64
_INV = pow(_ODD, -1, 1 << 64)

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

ALNUM = np.zeros(256, bool)  # 0-9, a-z and every byte of a non-ASCII character
ALNUM[ord("0"):ord("9") + 1] = True
ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_TABLE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def chunks(column: pa.Array, limit: int = CHUNK):
    """Yield (first row, row count, buffer, document starts): documents of consecutive rows, each
    followed by one blank; null counts as empty. `starts` has one element more than rows."""
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_binary())
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + rows + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, rows)
        n = end - at
        buf = np.full(int(offsets[end] - offsets[at]) + n, 0x20, np.uint8)
        starts = offsets[at:end + 1] - offsets[at] + np.arange(n + 1)
        for i in range(n):
            a, b = offsets[at + i], offsets[at + i + 1]
            buf[starts[i]:starts[i] + b - a] = data[a:b]
        yield at, n, buf, starts
        at = end


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last element must be False."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[::2], edge[1::2]


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def __reduce__(self):  # tasks grow their own
        return Powers, ()

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _ODD), ("down", _INV)):
                factors = np.full(size, base, U64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=U64))
        return self.up, self.down


POWERS = Powers()


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """P with P[0] = 0; (P[b] - P[a]) * base**-a is the hash of buf[a:b]."""
    up, _ = POWERS.get(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(_TABLE[buf] * up[:len(buf)], out=out[1:])
    return out


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = POWERS.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = CHUNK) -> np.ndarray:
    """A 64-bit hash of each word; long buffers are worked through in segments that end at words."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + limit, "right")))
        lo, hi = int(starts[at]), int(ends[stop - 1])
        sums = prefix_sums(buf[lo:hi])
        out[at:stop] = hashes(sums, starts[at:stop] - lo, ends[at:stop] - lo)
        at = stop
    return out


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every `length` consecutive word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for k in range(length):
        out *= U64(0xD1342543DE82EF95)
        out += words[k:k + n]
    return mix(out + U64(length))
