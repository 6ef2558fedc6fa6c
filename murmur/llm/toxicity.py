"""Toxicity scores behind noisy-channel deobfuscation.

Character model: four-letter counts over all documents, summed by Spark (each task sends its own
table). Channel: a spelling is a lattice over characters: look-alike symbols may stand for letters,
a run of one letter for one or two of it, and marks or blanks between letters for nothing. The
Viterbi algorithm finds the cheapest reading under the character model. Only spans where such an
alternative can be the cheapest are decoded, and each distinct one once a task: a doubled letter or a
gap is passed over only if its plain reading costs no more next to any reading of its neighbours.
Scoring needs restored words that have a mark only; every spelling of a mark has the same outline
(gaps dropped, look-alikes as letters, repeats once), so texts without such an outline are passed over.

Classifier: words and word beginnings of the restored texts of a bounded sample of labelled rows
(equal texts once) are counted by Spark; those that each mark many toxic rows are taken, and then a
cover of the toxic rows left is chosen step by step. A document's score is the noisy-or of the marks
that its restored text has.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import in_arrow, stored
from murmur.llm.textbytes import LOWER, U64, chunks, hashes, prefix_sums, spans

SYMBOLS = 28  # 0: anything but a letter, 1-26: a-z, 27: a byte of a letter beyond ASCII
ORDER = 4
#: Letters that symbols stand for in disguised spelling (fixed values).
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
MARKS = ".-_*~'/,"
COST = {"look": 1.0, "run": 0.5, "pair": 2.5, "skip": 0.5, "symbol": 4.0}

#: Bytes of text read at a time (a longer document is read whole), and readings of spans that a task remembers: both bound a worker's memory only.
PART = 1 << 17
READINGS = 1 << 16
SAMPLE_ROWS = 20_000
#: Features of the labelled sample, by their unconditional gain, among which the marks are chosen; with the sample it bounds what the fit holds in the driver.
CANDIDATES = 2000
PREFIXES = range(4, 8)
MIN_SUPPORT = 3

_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CLASS[0x80:] = 27
_LETTER = _CLASS > 0


def _codes(buf: np.ndarray) -> np.ndarray:
    """Codes of all runs of ORDER symbols in a lower-cased buffer."""
    c = _CLASS[buf]
    if len(c) < ORDER:
        return c[:0]
    out = c[:len(c) - ORDER + 1].copy()
    for k in range(1, ORDER):
        out *= SYMBOLS
        out += c[k:len(c) - ORDER + 1 + k]
    return out


def _count(batches):
    total = np.zeros(SYMBOLS ** ORDER, np.int64)
    for batch in batches:
        for _, _, buf, _ in chunks(batch.column(0)):
            total += np.bincount(_codes(LOWER[buf]), minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["code", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """-log P(symbol | the three before) as a table of SYMBOLS ** ORDER, from all of `docs`; each order
    backs off to the next lower one. What is collected is bounded by the table."""
    counted = docs.select(F.col(text_col).cast("string").alias("text")).transform(in_arrow, _count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS ** ORDER)
    counts[counted.column("code").to_numpy()] = counted.column("n").to_numpy()
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        c = counts.reshape(-1, SYMBOLS ** order).sum(0).reshape(-1, SYMBOLS)
        weight = 5.0 * SYMBOLS ** (order > 1)
        lower = (c + weight * np.tile(lower, (len(c) // len(lower.reshape(-1, SYMBOLS)), 1)).reshape(c.shape)) / (c.sum(1, keepdims=True) + weight)
    return -np.log(lower).astype(np.float32).ravel()


def decode(span: str, model: np.ndarray) -> str:
    """The cheapest reading of a span: letters, and a blank for whatever separates words."""
    n = len(span)
    arcs: list[list[tuple[int, str, float]]] = [[] for _ in range(n)]  # from each place: (to, written, cost)
    for i, ch in enumerate(span):
        if ch.isalpha():
            arcs[i].append((i + 1, ch, 0.0))
            j = i + 1
            while j < n and span[j] == ch:
                j += 1
            if j - i >= 3 and (i == 0 or span[i - 1] != ch):
                arcs[i] += [(j, ch, COST["run"]), (j, ch + ch, COST["run"])]
            elif j - i == 2 and (i == 0 or span[i - 1] != ch):
                arcs[i].append((j, ch, COST["pair"]))
        else:
            arcs[i].append((i + 1, " ", 0.0 if ch.isspace() or ch in MARKS else COST["symbol"]))
            for letter in LOOKALIKES.get(ch, ""):
                arcs[i].append((i + 1, letter, COST["look"]))
                j = i + 1
                while j < n and span[j] == ch:
                    j += 1
                if j - i >= 3:
                    arcs[i].append((j, letter, COST["look"] + COST["run"]))
            if (ch.isspace() or ch in MARKS) and 0 < i < n - 1:
                arcs[i].append((i + 1, "", COST["skip"]))
    code = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0
    best: list[dict] = [{} for _ in range(n + 1)]  # place -> last three symbols -> (cost, text)
    best[0][0] = (0.0, "")
    size = SYMBOLS ** (ORDER - 1)
    for i in range(n):
        for history, (cost, text) in best[i].items():
            for to, written, extra in arcs[i]:
                c, h = cost + extra, history
                for w in written:
                    at = h * SYMBOLS + code(w)
                    c += float(model[at])
                    h = at % size
                if h not in best[to] or c < best[to][h][0]:
                    best[to][h] = (c, text + written)
    ends = [(c + float(model[h * SYMBOLS]), t) for h, (c, t) in best[n].items()]
    return min(ends)[1]


_LOOK = np.zeros(256, bool)
_LOOK[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
_DIGITLIKE = _LOOK.copy()
_DIGITLIKE[[ord(c) for c in "!|+("]] = False
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_SOFT = _SPACE.copy()
_SOFT[[ord(c) for c in MARKS]] = True
_EURO = 0x01  # stands for the sign in a buffer of one byte a character
_LOOK[_EURO] = _DIGITLIKE[_EURO] = True
_HARD = 0x02  # signs beyond ASCII
_TRIM = re.compile(r"^[\"'(\[{<.,;:*#%&-]+|(?:[.,;:!?|)\]}>\"'*#%&-]|([$@+])\1\1+)+$")


def _characters(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte a character (letters beyond ASCII keep their first byte), and where each one starts;
    the last place is the length of `low`."""
    if not (low >= 0x80).any():
        return low, np.arange(len(low) + 1)
    at = np.flatnonzero((low & 0xC0) != 0x80)
    one = low[at].copy()
    one[(one == _EURO) | (one == _HARD)] = ord(";")
    two, three = (low[np.minimum(at + k, len(low) - 1)] for k in (1, 2))
    general = one == 0xE2
    euro, blank = general & (two == 0x82) & (three == 0xAC), ((one == 0xC2) & (two == 0xA0)) | (general & (two == 0x80) & (three <= 0x8A))
    one[general | ((one == 0xC2) & ~np.isin(two, [0xAA, 0xB5, 0xBA])) | (one >= 0xF0)] = _HARD
    one[euro], one[blank] = _EURO, 0x20
    return one, np.append(at, len(low))


def _steps(low: np.ndarray, gap: np.ndarray, far: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each character, and for a blank before each (offset by the length), what may stand before it
    when a text is read: its plain neighbour, and the one if a gap or a repeated letter goes."""
    n = len(low)
    letter = _LETTER[low]
    here = np.arange(n)
    prior = np.maximum(here - 1, 0)
    plain = np.where(letter[prior] & (here > 0), prior, here + n)
    other = np.where(plain < n, np.where(low[prior] == low, far, plain), np.where(gap, back, plain))
    blank = np.where(gap, back, here + n)
    return np.concatenate((plain, blank)), np.concatenate((other, here + n))


def _contexts(at: np.ndarray, steps: tuple, symbols: np.ndarray, count: int):
    """Symbols of `count` characters from `at` on, in every reading: tuples of arrays."""
    if count == 1:
        yield (symbols[at],)
        return
    for way in steps:
        for rest in _contexts(way[at], steps, symbols, count - 1):
            yield symbols[at], *rest


def _better(model: np.ndarray, lefts: list, rights: list, delta) -> np.ndarray:
    """Where `delta` (alternative less plain reading) is negative for any pair of contexts."""
    out = np.zeros(len(lefts[0][0]), bool)

    def cost(a, b, c, d):
        return model[((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d]
    seen = []
    for left in lefts:
        for right in rights:
            todo = ~out
            for x, y in seen:
                todo &= (sum(p != q for p, q in zip(left + right, x + y)) > 0)
            i = np.flatnonzero(todo)
            if len(i):
                out[i[delta(cost, [c[i] for c in left], [c[i] for c in right], i) < 1e-3]] = True
            seen.append((left, right))
    return out


def _alternatives(low: np.ndarray, model: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of doubled letters, and first and last place around gaps, that a cheapest reading may
    join. `edges`: places where documents end, which no gap reaches across."""
    n, letter, soft = len(low), _LETTER[low], _SOFT[low]
    before, after = spans(np.append(soft, False))
    ok = (before > 0) & (after < n)  # a gap has letters on both sides
    before, after = before[ok], after[ok]
    ok = letter[before - 1] & letter[after] & (np.searchsorted(edges, before) == np.searchsorted(edges, after))
    before, after = before[ok] - 1, after[ok]
    here = np.arange(n)
    change = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    ends = np.append(change[1:], n)
    which = np.repeat(np.arange(len(change)), ends - change)
    first, last = change[which], ends[which] - 1  # of the run of equal characters
    gap, back = np.zeros(n, bool), np.zeros(n, np.int64)
    gap[after], back[after] = True, before
    up = np.maximum(first - 1, 0)  # before the run
    lefts = _steps(low, gap, np.where(letter[up] & (first > 0), up, first + n), back)
    gap, back = np.zeros(n, bool), np.zeros(n, np.int64)
    gap[n - 1 - before], back[n - 1 - before] = True, n - 1 - after
    down = np.minimum(last + 1, n - 1)
    far = np.where(letter[down] & (last < n - 1), n - 1 - down, n - 1 - last + n)
    rights = _steps(low[::-1], gap, far[::-1], back)
    symbols = np.concatenate((_CLASS[low], np.zeros(n, np.int64)))
    mirror = np.concatenate((_CLASS[low[::-1]], np.zeros(n, np.int64)))

    def joined(cost, left, right, i):
        (c, b, a), (x, y, z), k, o = left, right, (after - before - 1)[i], np.zeros(len(i), np.int64)
        one = cost(a, b, c, o) + cost(b, c, o, x) + cost(c, o, x, y) + cost(o, x, y, z)
        all_ = cost(a, b, c, o) + cost(b, c, o, o) + np.where(k > 2, cost(c, o, o, o) + (k - 3) * model[0] + cost(o, o, o, x), cost(c, o, o, x)) + cost(o, o, x, y) + cost(o, x, y, z)
        apart = np.where(k == 1, one, np.minimum(one + COST["skip"] * (k - 1), all_))
        return COST["skip"] * k + cost(a, b, c, x) + cost(b, c, x, y) + cost(c, x, y, z) - apart

    def single(cost, left, right, i):
        (m, c, b), (l, x, y) = left, right
        return COST["pair"] + cost(b, c, l, x) + cost(c, l, x, y) - cost(b, c, l, l) - cost(c, l, l, x) - cost(l, l, x, y)
    wide = np.zeros(0, bool)
    if len(before):
        wide = _better(model, list(_contexts(before, lefts, symbols, 3)), list(_contexts(n - 1 - after, rights, mirror, 3)), joined)
    # a look-alike has readings of its own
    near = np.concatenate(([0], np.cumsum(_LOOK[low])))
    wide |= (near[before + 1] > near[np.maximum(before - 2, 0)]) | (near[np.minimum(after + 3, n)] > near[after])
    pair = np.flatnonzero(letter & (here == first) & (last == first + 1))
    if len(pair):
        pair = pair[_better(model, list(_contexts(pair, lefts, symbols, 3)), list(_contexts(n - 2 - pair, rights, mirror, 3)), single)]
    return pair, before[wide], after[wide]


def disguised(buf: np.ndarray, model: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of a lower-cased buffer whose cheapest reading may be another than what stands there:
    tokens with a look-alike beside a letter, a letter three times running or a doubled letter that may
    be one; tokens with gaps between that may be none; and runs of single letters with gaps between."""
    low, place = _characters(buf)
    edges = np.searchsorted(place, starts[1:] - 1)
    letter, look = _LETTER[low], _LOOK[low]
    flag = np.zeros(len(low), bool)
    flag[:-1] |= look[:-1] & letter[1:]
    flag[1:] |= _DIGITLIKE[low][1:] & letter[:-1]
    same = (low[1:] == low[:-1]) & letter[1:]
    flag[2:] |= same[1:] & same[:-1]
    pair, before, after = _alternatives(low, model, edges)
    flag[pair] = True
    a, b = spans(~_SPACE[low])
    hit = np.unique(np.searchsorted(a, np.flatnonzero(flag), "right") - 1)
    out = [(int(place[a[i]]), int(place[b[i]])) for i in hit if i >= 0]
    # tokens that gaps join
    one, two = np.searchsorted(a, before, "right") - 1, np.searchsorted(a, after, "right") - 1
    if len(one):
        new = np.concatenate(([True], one[1:] > two[:-1]))
        out += zip(place[a[one[new]]].tolist(), place[b[two[np.append(new[1:], True)]]].tolist())
    # x.y.z: single characters, runs of marks or blanks between, nothing else around
    unit, soft = letter | look, _SOFT[low]
    solo = unit & ~np.concatenate(([False], unit[:-1])) & ~np.concatenate((unit[1:], [False]))
    x, y = spans(unit | ~soft)
    single = solo[x] & (y - x == 1)
    own = np.searchsorted(edges, x)
    linked = single[1:] & single[:-1] & (own[1:] == own[:-1])
    if len(linked):
        p, q = spans(np.append(linked, False))
        count = np.concatenate(([0], np.cumsum(letter[x] & single)))
        out += [(int(place[x[i]]), int(place[x[j] + 1])) for i, j in zip(p.tolist(), q.tolist()) if j - i >= 2 and count[j + 1] - count[i] >= 2]
    return out


def _restorer(model: np.ndarray):
    known: dict[bytes, list[bytes]] = {}
    model = model.tolist()  # single values of a list are read faster

    def words(raw: bytes) -> list[bytes]:
        """Words of the reading of a span, if it differs from what stands there."""
        out = known.get(raw)
        if out is None:
            text = _TRIM.sub("", raw.decode("utf-8", "replace"))
            plain = re.findall(r"[^\W\d_]+", text)
            found = [w for piece in _pieces(text, model) for w in re.findall(r"[^\W\d_]+", piece)] if text else []
            if len(known) >= READINGS:
                known.clear()
            out = known[raw] = [w.encode() for w in dict.fromkeys(found) if w not in plain]
        return out
    return words


def _pieces(text: str, model: np.ndarray, most: int = 64):
    """Readings of pieces: a very long span (an address, a key, a row of one letter) is decoded from
    separator to separator where it has one. Half of a piece is read again with the next one, so that
    a word at a cut is whole in one of them."""
    while len(text) > most:
        cut = max((m.end() for m in re.finditer(r"[^\w@$!|+]", text[:most])), default=most)
        yield decode(text[:cut], model)
        again = max((m.end() for m in re.finditer(r"[^\w@$!|+]", text[:max(cut - most // 2, 1)])), default=max(cut - most // 2, 1))
        text = text[again:]
    yield decode(text, model)


_CANON = np.arange(256, dtype=np.uint8)
for _sign, _letters in {**LOOKALIKES, "l": "i"}.items():
    _CANON[_EURO if _sign == "€" else ord(_sign)] = ord(_letters[0])


def _outline(low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What all spellings of a word share: letters without gaps, look-alikes as letters (i and l as one),
    repeats once; and the bytes where each letter's run starts and ends."""
    one, place = _characters(low)
    at = np.flatnonzero(~_SOFT[one])
    out = _CANON[one[at]]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(out), 1), bool), out[1:] != out[:-1])))
    last = np.append(first[1:], len(out))[:len(first)] - 1
    return out[first], place[at[first]], place[at[last] + 1]


_GAPS = b"(?:[" + b"".join(b"\\x%02x" % c for c in np.flatnonzero(_SOFT)) + rb"]|\xc2\xa0|\xe2\x80[\x80-\x8a])*"


def _spellings(word: bytes) -> re.Pattern:
    """All spellings of a word: as many signs for each letter at least, gaps between."""
    out = b""
    for m in re.finditer(rb"([\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*)\1*", word):
        c = m[1]
        signs = [c] if c[0] < 0x80 else [c if len(c.decode("utf-8", "ignore")) else c + rb"[\x80-\xbf]+"]
        signs += [re.escape(k.encode()) for k, v in LOOKALIKES.items() if c.decode("utf-8", "ignore") in list(v)]
        out += b"(?:(?:" + b"|".join(signs) + b")" + _GAPS + b"){%d,}" % (len(m[0]) // len(c))
    return re.compile(out)


def _suspects(low: np.ndarray, starts: np.ndarray, spellings: dict[bytes, re.Pattern]) -> dict[int, list[tuple[int, int]]]:
    """Documents and places in them where a feature is spelled otherwise than as it is."""
    outline, lo, hi = _outline(low)
    text, raw = outline.tobytes(), low.tobytes()
    out: dict[int, list[tuple[int, int]]] = {}
    for f, spelled in spellings.items():
        word = f.removeprefix(b"=")
        key = _outline(np.frombuffer(word, np.uint8))[0].tobytes()
        at = text.find(key)
        while at >= 0:
            x, y = int(lo[at]), int(hi[at + len(key) - 1])
            # as it is: no reading takes a letter from it, and only a beginning can grow by what follows
            if (raw[x:y] != word or (f[:1] != b"=" and not _LETTER[low[y]])) and spelled.match(raw, x, y):
                i = int(np.searchsorted(starts, x, "right")) - 1
                out.setdefault(i, []).append((x - int(starts[i]), y - int(starts[i])))
            at = text.find(key, at + 1)
    return out


def _restored(low: np.ndarray, starts: np.ndarray, restore, model: np.ndarray, places: dict | None = None) -> list[tuple[int, bytes]]:
    """Words of other readings as (document, word); with `places`, of spans that meet one of them."""
    which = np.arange(len(starts) - 1) if places is None else np.array(sorted(places), np.int64)
    if not len(which):
        return []
    if places is not None:
        low = np.concatenate([low[starts[i]:starts[i + 1]] for i in which])
        starts = np.concatenate(([0], np.cumsum(starts[which + 1] - starts[which])))
    raw, out = low.tobytes(), []
    for x, y in disguised(low, model, starts):
        i = int(np.searchsorted(starts, x, "right")) - 1
        if places is None or any(x - starts[i] < q and p < y - starts[i] for p, q in places[int(which[i])]):
            out += [(int(which[i]), w) for w in restore(raw[x:y])]
    return out


def _features(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("features", pa.list_(pa.binary()))])

    def of(words):
        out = set()
        for w in words:
            out.add(b"=" + w)
            out.update(w[:k] for k in PREFIXES if len(w) > k)
        return sorted(out)

    def run(batches):
        restore = _restorer(shared.value)
        for batch in batches:
            for at, n, buf, starts in chunks(batch.column(2), PART):
                low = LOWER[buf]
                raw = low.tobytes()
                a, b = spans(_LETTER[low])
                first, extra = np.searchsorted(a, starts), _restored(low, starts, restore, shared.value)
                words = [{raw[x:y] for x, y in zip(a[first[i]:first[i + 1]].tolist(), b[first[i]:first[i + 1]].tolist())} for i in range(n)]
                for i, w in extra:
                    words[i].add(w)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array([of(w) for w in words], pa.list_(pa.binary()))], schema=schema)
    return run


def _marks(rows: list[set], labels: np.ndarray, candidates: list[bytes], share_of_toxic: float = 0.05, purity: float = 0.95) -> dict[bytes, float]:
    """Chosen features with -log(1 - P(toxic | feature)). First those that mark `share_of_toxic` of the
    toxic rows and hardly a clean one, but for near repeats of one another; then, one by one, the best
    at telling the toxic rows among those that no chosen one marks."""
    index = {f: j for j, f in enumerate(candidates)}
    has = np.zeros((len(rows), len(candidates)), bool)
    for i, features in enumerate(rows):
        for f in features:
            has[i, index[f]] = True
    toxic, clean = has[labels == 1], has[labels == 0]
    a, b = toxic.sum(0).astype(float), clean.sum(0).astype(float)
    chosen: list[int] = []
    for j in sorted(range(len(candidates)), key=lambda j: (b[j] - a[j], j)):
        if a[j] >= max(2 * MIN_SUPPORT, share_of_toxic * len(toxic)) and a[j] >= purity * (a[j] + b[j]) \
                and all((toxic[:, j] & toxic[:, k]).sum() < 0.8 * (toxic[:, j] | toxic[:, k]).sum() for k in chosen):
            chosen.append(j)
    while True:
        open_ = ~has[:, chosen].any(1)
        at, bt = has[open_ & (labels == 1)].sum(0), has[open_ & (labels == 0)].sum(0)
        p = ((open_ & (labels == 1)).sum() + 1) / (open_.sum() + 2)
        share = (at + p) / (at + bt + 1)
        gain = np.where((at >= MIN_SUPPORT) & (at > bt), at * np.log(np.maximum(share, 1e-9) / p) + bt * np.log(np.maximum(1 - share, 1e-9) / (1 - p)), 0)
        if gain.max() < np.log(len(candidates) + 1) + 3:
            break
        chosen.append(int(gain.argmax()))  # the first of equals: shorter features come first
    return {candidates[j]: float(-np.log(1 - (a[j] + 0.1) / (a[j] + b[j] + 0.2))) for j in chosen}


def fit(docs: DataFrame, labels: DataFrame, model, id_col: str, text_col: str, sample_rows: int) -> dict:
    """Weights of the features and the bias, from at most `sample_rows` labelled rows (the first by a
    hash of the id). Features are counted by Spark; what is fetched is bounded by that number."""
    spark = docs.sparkSession
    sample = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(stored(sample, "sample")), "doc_id").select("doc_id", "toxic", "text")
    rows = rows.transform(in_arrow, _features(model), "doc_id long, toxic int, features array<binary>")
    rows = stored(rows.withColumn("same", F.xxhash64("features")).dropDuplicates(["same", "toxic"]), "features")
    total = {r[0]: r[1] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    rate = (total.get(1, 0) + 0.1) / (total.get(0, 0) + total.get(1, 0) + 0.2) if total else 0.0
    only_bias = {"bias": float(-np.log(1 - rate)), "weights": {}}
    if not total.get(1) or not total.get(0):
        return only_bias
    counted = rows.select((F.col("toxic") > 0).cast("int").alias("toxic"), F.explode("features").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    counted = counted.where((F.col("a") >= MIN_SUPPORT) & (F.col("a") > (F.col("n") - F.col("a")))).withColumn("gain", F.col("a") * F.log(F.col("a") / F.col("n") / rate))
    top = [bytes(r["f"]) for r in counted.orderBy(F.desc("gain"), F.length("f"), "f").limit(CANDIDATES).collect()]
    if not top:
        return only_bias
    top.sort(key=lambda f: (len(f), f))
    named = spark.createDataFrame([(f,) for f in top], "f binary").withColumn("known", F.lit(True))
    found = rows.select("doc_id", "toxic", F.explode_outer("features").alias("f")).join(F.broadcast(named), "f", "left") \
        .groupBy("doc_id", "toxic").agg(F.collect_set(F.when(F.col("known"), F.col("f"))).alias("fs")).collect()
    sets, y = [{bytes(f) for f in r["fs"]} for r in found], np.array([int(r["toxic"] > 0) for r in found])
    weights = _marks(sets, y, top)
    rest = np.array([not (s & weights.keys()) for s in sets])
    left = (y[rest].sum() + 0.1) / (rest.sum() + 0.2) if rest.any() else rate
    return {"bias": float(-np.log(1 - left)), "weights": weights}


def _score(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        model, fitted = shared.value
        restore = _restorer(model)
        names = sorted(fitted["weights"])
        spellings = {f: _spellings(f.removeprefix(b"=")) for f in names}
        weights = np.array([fitted["weights"][f] for f in names])
        lengths = sorted({len(f) for f in names if f[:1] != b"="})

        def key(raw: bytes) -> int:
            buf = np.frombuffer(raw, np.uint8)
            return int(hashes(prefix_sums(buf), np.array([0]), np.array([len(buf)]))[0])
        order = sorted((key(f.removeprefix(b"=")), f[:1] != b"=", j) for j, f in enumerate(names))
        keys = {p: (np.array([k for k, q, _ in order if q == p], U64), np.array([j for _, q, j in order if q == p], np.int64)) for p in (False, True)}

        def hits(h, doc, prefix, has):
            known, which = keys[prefix]
            if len(known):
                at = np.searchsorted(known, h)
                at[at == len(known)] = 0
                ok = known[at] == h
                has[doc[ok], which[at[ok]]] = True
        for batch in batches:
            for at, n, buf, starts in chunks(batch.column(1), PART):
                low = LOWER[buf]
                a, b = spans(_LETTER[low])
                first, extra = np.searchsorted(a, starts), _restored(low, starts, restore, model, _suspects(low, starts, spellings))
                has = np.zeros((n, len(names)), bool)
                doc = np.repeat(np.arange(n), np.diff(first))
                for lo in range(0, len(a), 1 << 18):
                    x, y, d = a[lo:lo + (1 << 18)], b[lo:lo + (1 << 18)], doc[lo:lo + (1 << 18)]
                    sums = prefix_sums(low[x[0]:y[-1]])
                    x, y = x - a[lo], y - a[lo]
                    hits(hashes(sums, x, y), d, False, has)
                    for k in lengths:
                        long = np.flatnonzero(y - x > k)
                        hits(hashes(sums, x[long], x[long] + k), d[long], True, has)
                for i, w in extra:
                    for j, f in enumerate(names):
                        if w == f[1:] if f[:1] == b"=" else len(w) > len(f) and w.startswith(f):
                            has[i, j] = True
                z = has @ weights + fitted["bias"] if names else np.full(n, fitted["bias"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(1 - np.exp(-z))], schema=schema)
    return run


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def toxicity(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted.

    Learns from the labelled rows (doc_id, toxic) of `corpus` (default: `docs`) whose crc32(doc_id as
    text) mod 4 is not 2, and at most `sample_rows` of them. Labels, language, source and id are no
    inputs of a score. A null or empty text gets the score of a text without any feature. Labels with
    a null id or value are ignored; of several labels of one id the highest counts. Without labelled
    rows of both kinds every score is the same, 0 without any labelled row. Repeated rows repeat; a null id has held_out = false.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    corpus = docs if corpus is None else corpus
    shared = spark.sparkContext.broadcast(character_model(corpus, text_col))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null").where(~held_out())
    fitted = fit(corpus, marked, shared, id_col, text_col, sample_rows)
    both = spark.sparkContext.broadcast((shared.value, fitted))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.transform(in_arrow, _score(both), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
