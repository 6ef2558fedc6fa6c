"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches in a word by their ends; the Viterbi
recursion carries the best score and the number of pieces of that path for the last few places only
(the longest piece's length). Tie rules are those of the unigram tokenizers: a later candidate must
score strictly better, and candidates for a place come by ascending start, so the longest piece wins a
tie; a character that is no piece costs the lowest score less 10 and counts as its UTF-8 bytes (with
byte fallback) or, with its neighbours of that kind, as one unknown piece. Texts are cut before every
blank, blanks are written as U+2581, and a first one is added where the text has none; every
distinct word is worked out once a task.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import in_arrow

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 1_000_000


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor
    m = SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]


class Counter:
    """Best score and piece count of words; `vocabulary` lists (piece, score)."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.window = max((len(p) for p, _ in vocabulary), default=0) + 1
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        self.known: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        size, singles = self.window, self.singles
        score, count, open_ = [0.0] * size, [0] * size, [False] * size  # rings over places; open_: the path ends in an unknown piece
        matches = self.automaton.iter(word) if len(self.automaton) else iter(())
        match = next(matches, None)
        for end, ch in enumerate(word):
            best = None
            while match is not None and match[0] == end:  # longest first
                length, s = match[1]
                at = (end + 1 - length) % size
                s += score[at]
                if best is None or s > best[0]:
                    best = (s, count[at] + 1, False)
                match = next(matches, None)
            if ch not in singles:
                at = end % size
                s = score[at] + self.unknown
                if best is None or s > best[0]:
                    best = (s, count[at] + (len(ch.encode("utf-8", "replace")) if self.byte_fallback else not open_[at]), True)
            at = (end + 1) % size
            score[at], count[at], open_[at] = best
        at = len(word) % size
        return score[at], count[at]

    def text(self, text: str) -> tuple[float, int]:
        """Best score and number of pieces of a whole text."""
        if not text:
            return 0.0, 0
        words = text.replace(BLANK, " ").split(" ")
        if words[0] == "":  # the text begins with a blank of its own
            del words[0]
        known, score, count = self.known, 0.0, 0
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            found = known.get(w)
            if found is None:
                found = known[w] = self.word(BLANK + w)
            score += found[0]
            count += found[1]
        return score, count


def _count(shared, byte_fallback: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches):
        counter = Counter(shared.value, byte_fallback)
        for batch in batches:
            found = [counter.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())], schema=schema)
    return run


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], byte_fallback: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, score (of the best segmentation).

    Null and empty texts have no tokens and score 0. Repeated rows repeat; a null id stays. Other
    columns are ignored; an empty table gives an empty result. The vocabulary is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.transform(in_arrow, _count(shared, byte_fallback), "doc_id long, n_tokens long, score double")
