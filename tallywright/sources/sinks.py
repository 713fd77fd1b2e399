"""Key/value text output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def write_kv(
    df: DataFrame, path: str, key: str | None = None, value: str | None = None
) -> None:
    """Write ``key<TAB>value`` lines into a new directory; fails if the path exists.

    Arrays are written as comma-separated numbers. Nothing is quoted or escaped.
    """
    key = key or df.columns[0]
    value = value or df.columns[1]
    text = {
        name: F.array_join(F.col(name).cast("array<string>"), ",")
        if isinstance(df.schema[name].dataType, ArrayType)
        else F.col(name).cast("string")
        for name in (key, value)
    }
    lines = df.select(F.concat_ws("\t", text[key], text[value]).alias("value"))
    lines.write.mode("errorifexists").text(path)
