"""Projections, filters, casts and conditional columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.numeric import normal_or_attack, parity
from tallywright.sources.text import literal_pattern


def split_fields(
    df: DataFrame, sep: str, spec: Mapping[str, tuple[int, str]], value: str = "value"
) -> DataFrame:
    """Split a text column and add ``name -> (position, type)`` fields.

    A missing or malformed field is null instead of an error.
    """
    fields = F.split(value, literal_pattern(sep))
    return df.withColumns(
        {name: F.get(fields, F.lit(place)).try_cast(kind) for name, (place, kind) in spec.items()}
    )


def field_count(df: DataFrame, sep: str = ",", value: str = "value") -> DataFrame:
    """Lines per number of fields over the whole input, which also shows ragged lines."""
    fields = F.size(F.split(value, literal_pattern(sep)))
    return df.groupBy(fields.alias("fields")).agg(F.count("*").alias("lines"))


def parity_label(df: DataFrame, column: str, out: str = "parity") -> DataFrame:
    """Add ``Even``/``Odd``; null for a null number."""
    return df.withColumn(out, parity(F.col(column)))


def binarize_label(
    df: DataFrame, column: str, normal: str = "normal.", out: str = "new_label"
) -> DataFrame:
    """Add ``normal``/``attack``; a null label counts as an attack."""
    return df.withColumn(out, normal_or_attack(F.col(column), normal))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Change column types in place; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove columns; a column that is not there is an error."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Remove rows with a null or NaN in one of the columns."""
    return df.dropna(subset=list(subset))


def filter_nonempty(df: DataFrame, column: str) -> DataFrame:
    """Remove rows whose text is empty or null."""
    return df.filter(F.col(column) != "")


def filter_class(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a value; null never matches."""
    return df.filter(F.col(column) == F.lit(value))
