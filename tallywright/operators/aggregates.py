"""Counts, sums and means per group. All combine on the map side before their one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.numeric import log_bucket
from tallywright.operators.columns import parity_label
from tallywright.operators.text import tokenize_ws


def line_count(df: DataFrame) -> DataFrame:
    """``('line', n)``, and no row at all for empty input."""
    return df.groupBy(F.lit("line").alias("key")).agg(F.count("*").alias("count"))


def count_by(
    df: DataFrame, key: str, ascending: bool = True, drop_nulls: bool = False
) -> DataFrame:
    """Frequency table of one column, sorted by count and then key."""
    rows = df.filter(F.col(key).isNotNull()) if drop_nulls else df
    counts = rows.groupBy(key).agg(F.count("*").alias("count"))
    return counts.orderBy(F.asc("count") if ascending else F.desc("count"), key)


def parity_count(df: DataFrame, column: str) -> DataFrame:
    """Number of even and odd values."""
    return parity_label(df, column).groupBy("parity").agg(F.count("*").alias("count"))


def sum_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Sum per group; a group of nulls sums to null."""
    return df.groupBy(key).agg(F.sum(value).alias(out or f"{value}_sum"))


def avg_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Mean per group."""
    return df.groupBy(key).agg(F.avg(value).alias(out or f"avg_{value}"))


def word_count(df: DataFrame, column: str = "value", unicode: bool = False) -> DataFrame:
    """Occurrences of every blank-separated word, by default between ASCII blanks."""
    return (
        tokenize_ws(df, column, unicode=unicode).groupBy("word").agg(F.count("*").alias("count"))
    )


def selected_word_count(
    df: DataFrame, column: str, words: Sequence[str], unicode: bool = True
) -> DataFrame:
    """Occurrences of the listed words as whole, case-sensitive tokens; absent words give no row."""
    hits = tokenize_ws(df, column, unicode=unicode).filter(F.col("word").isin(list(words)))
    return hits.groupBy("word").agg(F.count("*").alias("count"))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows. Copies within a partition are merged before the shuffle."""
    return df.dropDuplicates()


def log_density(
    df: DataFrame, x: str, y: str, label: str, per_decade: int = 1
) -> DataFrame:
    """Rows per label and log-log cell; values without a logarithm fall into a null bucket."""
    return df.groupBy(
        F.col(label).alias("label"),
        log_bucket(F.col(x), per_decade).alias("bucket_x"),
        log_bucket(F.col(y), per_decade).alias("bucket_y"),
    ).agg(F.count("*").alias("count"))


def label_palette_keys(df: DataFrame, label: str, normal: str = "normal.") -> DataFrame:
    """Distinct labels, the normal one flagged."""
    labels = df.select(F.col(label).alias("label")).distinct()
    return labels.withColumn("is_normal", F.coalesce(F.col("label") == normal, F.lit(False)))
