"""Text expressions with Unicode semantics, written with explicit character classes.

The classes are spelled out because ``\\s``, ``\\w`` and ``\\d`` are ASCII-only in Java, while the
text rules reproduced here count every Unicode blank, letter and digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks of Unicode text, word characters (letters, numbers, underscore) and
# decimal digits. Blanks are named by property, which Java tests much faster than a list of ranges.
BLANKS = r"\s\x1c-\x1f\x{85}\p{Z}"
WORD_CHARS = r"\p{L}\p{N}_"
UNICODE_BLANK_RUN = f"[{BLANKS}]+"
ASCII_BLANK_RUN = r"\s+"
TERM = f"[{WORD_CHARS}]{{2,}}"
DIGIT_RUN = r"\p{Nd}+"
PUNCTUATION = f"[^{WORD_CHARS}{BLANKS}]"


def blank_split(text: str | Column, unicode: bool = True) -> Column:
    """Pieces between runs of blanks; a leading or trailing blank leaves an empty piece."""
    return F.split(_col(text), UNICODE_BLANK_RUN if unicode else ASCII_BLANK_RUN)


def blank_word_count(text: str | Column, unicode: bool = True) -> Column:
    """Number of blank-separated words."""
    return F.size(F.filter(blank_split(text, unicode), lambda word: word != ""))


def terms(text: str | Column) -> Column:
    """Lower-cased runs of two or more word characters, in text order, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(TERM), F.lit(0))


def cleaned(text: str | Column) -> Column:
    """Lower-case, delete digits, collapse blanks, then delete punctuation.

    Blanks are collapsed *before* punctuation goes, so ``"a - b"`` ends with two blanks, and the
    result is not trimmed.
    """
    lowered = F.lower(_col(text))
    without_digits = F.regexp_replace(lowered, DIGIT_RUN, "")
    single_blanks = F.regexp_replace(without_digits, UNICODE_BLANK_RUN, " ")
    return F.regexp_replace(single_blanks, PUNCTUATION, "")


def stop_list(stop_words: str | Sequence[str] | None) -> list[str]:
    """A given list as it is; a language name stands for Spark's own list of that language."""
    if isinstance(stop_words, str):
        return list(StopWordsRemover.loadDefaultStopWords(stop_words))
    return list(stop_words or [])


def not_stop_word(word: str | Column, stop_words: str | Sequence[str] | None) -> Column:
    """True for words outside the stop list; always true without a list."""
    listed = stop_list(stop_words)
    return ~_col(word).isin(listed) if listed else F.lit(True)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
