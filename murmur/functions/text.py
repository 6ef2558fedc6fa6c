"""String helpers as native column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word splitter for frequent-word reports: any run of characters that is not a letter (any script)
# or an ASCII digit separates words.
WORD_SPLIT = r"[^\p{L}0-9]+"

# Words left out of the frequent-word report (articles, pronouns, conjunctions and
# prepositions of the four test languages plus Indonesian, whose news sources the engine targets).
STOP_WORDS = (
    "a an and are as at be but by for from has have he her his i in is it its of on or she that the "
    "their them they this to was were will with you "
    "au aux avec ce dans de des du elle en est et il la le les ou par pas pour qui que sur un une "
    "am auf das dem den der die ein eine er es ich im in ist mit nicht sie und zu "
    "al con del el en es la las los para por que se su un una y "
    "ada dan dari di dengan ini itu ke untuk yang"
).split()


def blank_to_null(c: Column | str) -> Column:
    """'' -> NULL, so that `coalesce` falls through empty strings like Python's `a or b`."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def first_nonblank(*cols: Column | str) -> Column:
    """Python `a or b or c` over strings: the first value that is neither NULL nor ''."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def words(c: Column | str) -> Column:
    """Array of lower-cased words of a text column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(F.lower(c), WORD_SPLIT)
