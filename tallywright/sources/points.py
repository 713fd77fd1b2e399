"""Readers for numeric points and centroid files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CENTROID_SCHEMA = "cid int, c array<double>"
#: Default of the most centroids, which are literals of the plan or part of a task's closure.
MAX_CENTROIDS = 10_000


def number_array(text: Column) -> Column:
    """Comma-separated numbers as ``array<double>``; a piece that is no number is null.

    Trailing empty fields do not count, so ``"1,2,"`` has two dimensions.
    """
    pieces = F.split(F.regexp_replace(text, ",+$", ""), ",")
    return F.transform(pieces, lambda piece: piece.try_cast("double"))


def read_points(lines: DataFrame, value: str = "value", out: str = "x") -> DataFrame:
    """Replace a text column by the array of its numbers; other columns stay."""
    rest = [name for name in lines.columns if name != value]
    return lines.select(*rest, number_array(F.col(value)).alias(out))


def read_seeds(spark: SparkSession, path: str, k: int, most: int = MAX_CENTROIDS) -> DataFrame:
    """The first ``k`` lines of one file as centroids 0..k-1, in line order.

    Only ``k`` lines are read off the front of the file, whatever its size. They pass through the
    driver; ``most`` guards it.
    """
    if not 0 < k <= most:
        raise ValueError(f"k must be between 1 and {most}")
    lines = read_points(spark.read.text(path), out="c").take(k)
    rows = [(cid, row.c) for cid, row in enumerate(lines)]
    for cid, centre in rows:
        if not centre or any(number is None for number in centre):
            raise ValueError(f"seed line {cid + 1} is not a list of numbers")
    return spark.createDataFrame(rows, CENTROID_SCHEMA)


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``id<blank>c1,c2,...`` lines as ``(cid, c)``; the written id is kept."""
    parts = F.split(F.trim("value"), r"\s+")
    return (
        spark.read.text(path)
        .select(parts.alias("parts"))
        .select(
            F.get("parts", F.lit(0)).try_cast("int").alias("cid"),
            number_array(F.get("parts", F.lit(1))).alias("c"),
        )
    )


def centroid_rows(centroids: DataFrame, most: int = MAX_CENTROIDS) -> list[tuple[int, list[float]]]:
    """Bring a centroid table to the driver, refusing one of more than ``most`` rows."""
    rows = centroids.select("cid", "c").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} centroids")
    if len({row.cid for row in rows}) < len(rows):
        raise ValueError("centroid ids repeat")
    return sorted((row.cid, list(row.c)) for row in rows)
