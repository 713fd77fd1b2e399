"""Names of helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have yet."""
    taken, name = {column.lower() for column in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
