"""Line and delimited-file readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per line in column ``value``; plain or compressed text.

    A gzip file cannot be split, so one task reads it whole. ``partitions`` spreads its lines over
    that many tasks before the work that follows; leave it out for splittable input.
    """
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def spread(scan: DataFrame, *key: str) -> DataFrame:
    """Give a scan that splits into fewer parts than there are task slots one part per slot.

    Meant for scans of unsplittable files with much work per row behind them. Input that splits
    well enough, as large input does, is left as it is. The key should tell most rows apart; with
    none the rows are dealt out in turn.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(slots, *key) if scan.rdd.getNumPartitions() < slots else scan


def read_table_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Headered CSV as a typed table.

    Give a schema for large input: without one the types are inferred, which reads the data twice.
    ``multi_line`` lets quoted fields hold line breaks; such files are not splittable.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if multi_line:
        reader = reader.option("multiLine", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def infer_csv_schema(spark: SparkSession, path: str, sample_lines: int = 10_000) -> StructType:
    """Column names and types of headered CSV, from the first lines only.

    ``sample_lines`` bounds what passes through the driver; a value further on that does not fit
    the inferred type is malformed.
    """
    first = [row.value for row in spark.read.text(path).limit(sample_lines + 1).collect()]
    if not first:
        raise ValueError(f"no lines in {path}")
    reader = spark.read.option("header", True).option("inferSchema", True).option("escape", '"')
    return reader.csv(spark.sparkContext.parallelize(first, 1)).schema


def read_checked_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    sample_lines: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """Headered CSV as ``(rows, malformed)``: typed rows, and the lines that are none, as ``value``.

    A line is malformed if it has too many or too few fields or one that its column's type does not
    hold. Both sides come from one reading of the lines each; no field holds a line break. Without
    a schema it is inferred from a sample, see :func:`infer_csv_schema`. Header lines, the first of
    each file, are those equal to the header.
    """
    if schema is None:
        schema = infer_csv_schema(spark, path, sample_lines)
    typed = _parse(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path)
    header = ",".join(typed.names)
    body = lines.filter((F.col("value") != header) & (F.trim("value") != ""))
    broken = "__malformed"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "escape": '"'}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed) + f", {broken} string"
    parsed = body.select("value", F.from_csv("value", ddl, options).alias("row"))
    good = parsed.filter(F.col(f"row.{broken}").isNull()).select(*[F.col(f"row.`{name}`").alias(name) for name in typed.names])
    return good, parsed.filter(F.col(f"row.{broken}").isNotNull()).select("value")


def _parse(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def read_positional(
    lines: DataFrame, ordinals: Mapping[str, int], sep: str = ",", value: str = "value"
) -> DataFrame:
    """Header-less delimited lines to named string columns picked by position.

    Fields are not quoted. A line too short for an ordinal gives null in that column.
    """
    fields = lines.select(F.split(value, literal_pattern(sep)).alias("fields"))
    return fields.select(
        *[F.get("fields", F.lit(place)).alias(name) for name, place in ordinals.items()]
    )


def literal_pattern(sep: str) -> str:
    """The separator as a pattern that matches it literally."""
    return sep if sep.isalnum() or sep in {",", " ", "\t", ";", ":"} else rf"\Q{sep}\E"
