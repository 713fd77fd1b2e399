"""Previews and top-k reports of any length.

A short report is ``orderBy().limit()``, which keeps only k rows per task and merges them in one. A
long one is ranked in ranges of its order (:func:`with_place`), so that no task sees all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.naming import spare_name
from tallywright.operators.aggregates import avg_by
from tallywright.operators.numbering import with_place
from tallywright.operators.text import tokenize_terms

#: Rows that one task may rank.
REPORT_ROWS = 10_000


def preview(df: DataFrame, order: str | Sequence[str], n: int = 10) -> DataFrame:
    """First n rows by a key; without one the rows would not be the same twice."""
    return _first(df, [order] if isinstance(order, str) else list(order), n)


def top_words(counts: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent words of a word count; ties in word order."""
    return _first(counts, [F.desc("count"), "word"], n)


def bottom_words(counts: DataFrame, n: int = 15) -> DataFrame:
    """Least frequent words of a word count; ties in word order."""
    return _first(counts, ["count", "word"], n)


def top_rated(df: DataFrame, key: str, value: str = "rating", n: int = 12) -> DataFrame:
    """Items, or users, with the highest mean; ties in key order."""
    return _first(avg_by(df, key, value, "avg_rating"), [F.desc("avg_rating"), key], n)


def top_terms_by_class(
    df: DataFrame,
    column: str,
    label: str,
    n: int = 10,
    stop_words: str | Sequence[str] | None = "english",
    classes: Sequence[object] | None = None,
    max_features: int = 1000,
) -> DataFrame:
    """Most frequent terms of every class in one pass; ties in term order.

    Rows without a class are left out. Only the ``max_features`` most frequent terms of a class
    take part, which matters when ``n`` is larger. The rank filter is applied before the shuffle
    too, so a class that holds most of the rows still sends only its best terms per task. Longer
    reports than one task may rank are ranked in ranges of class and count.
    """
    keep = _positive(min(n, max_features))
    rows = df.filter(F.col(label).isNotNull())
    if classes is not None:
        rows = rows.filter(F.col(label).isin(list(classes)))
    counts = (
        tokenize_terms(rows, column, keep=[label], stop_words=stop_words)
        .groupBy(label, "term")
        .agg(F.count("*").alias("count"))
    )
    if keep <= REPORT_ROWS:
        place = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("count"), "term"))
        return counts.withColumn("rank", place).filter(F.col("rank") <= keep)
    placed = with_place(counts, [label, F.desc("count"), "term"], "rank")
    firsts = placed.groupBy(label).agg(F.min("rank").alias("__first"))  # one row for each class
    rank = (F.col("rank") - F.col("__first") + 1).cast("int")
    return placed.join(F.broadcast(firsts), label).withColumn("rank", rank).drop("__first").filter(F.col("rank") <= keep)


def term_weights(
    df: DataFrame,
    column: str,
    label: str,
    value: object,
    max_words: int = 200,
    stop_words: str | Sequence[str] | None = "english",
) -> DataFrame:
    """Frequency of a class's terms relative to its most frequent one."""
    counts = (
        tokenize_terms(df.filter(F.col(label) == F.lit(value)), column, stop_words=stop_words)
        .groupBy("term")
        .agg(F.count("*").alias("count"))
    )
    report = _first(counts, [F.desc("count"), "term"], max_words)
    if max_words <= REPORT_ROWS:
        # one window over the report itself, not the data
        highest = F.max("count").over(Window.partitionBy(F.lit(1)))
    else:
        highest = report.agg(F.max("count")).scalar()
    return report.withColumn("weight", F.col("count") / highest)


def _first(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows of an order that tells rows apart."""
    if _positive(n) <= REPORT_ROWS:
        return df.orderBy(*order).limit(n)
    place = spare_name(df, "place")
    return with_place(df, order, place).filter(F.col(place) < n).drop(place)


def _positive(n: int) -> int:
    if n < 1:
        raise ValueError("a report has 1 row or more")
    return n
