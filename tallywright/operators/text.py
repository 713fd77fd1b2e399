"""Row-level text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions import text as T


def tokenize_ws(
    df: DataFrame,
    column: str = "value",
    keep: Sequence[str] = (),
    unicode: bool = True,
    out: str = "word",
) -> DataFrame:
    """One row per blank-separated word. ``unicode=False`` splits at ASCII blanks only."""
    words = F.explode(T.blank_split(column, unicode)).alias(out)
    return df.select(*keep, words).filter(F.col(out) != "")


def tokenize_terms(
    df: DataFrame,
    column: str,
    keep: Sequence[str] = (),
    stop_words: str | Sequence[str] | None = None,
    out: str = "term",
) -> DataFrame:
    """One row per lower-case term of two or more characters, repeats kept."""
    rows = df.select(*keep, F.explode(T.terms(column)).alias(out))
    return rows.filter(T.not_stop_word(out, stop_words)) if stop_words else rows


def token_length(df: DataFrame, column: str, out: str = "comment_length") -> DataFrame:
    """Add the number of blank-separated words."""
    return df.withColumn(out, T.blank_word_count(column))


def clean_text(df: DataFrame, column: str) -> DataFrame:
    """Clean a text column in place."""
    return df.withColumn(column, T.cleaned(column))
