"""Words, letters and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but blank and the control characters tab to return.
WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have yet."""
    taken, name = {column.lower() for column in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
