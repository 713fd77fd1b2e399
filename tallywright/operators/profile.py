"""Table profiles: one aggregation pass over all columns, turned into one row per column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from tallywright.operators.selection import order_statistics, sketch

QUARTILES = (0.25, 0.5, 0.75)
#: Default of the most bins of a histogram.
MOST_BINS = 1_000_000


def describe_table(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per numeric or string column.

    Numeric extremes are in ``min``/``max``, those of strings in ``min_text``/``max_text``.
    """
    aggregates: list[Column] = []
    rows: list[Column] = []
    for field in df.schema.fields:
        name = field.name
        numeric = isinstance(field.dataType, NumericType)
        if not numeric and not isinstance(field.dataType, StringType):
            continue
        x = F.col(f"`{name}`")
        measured = x.cast("double") if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else x
        parts = {
            "count": F.count(x),
            "mean": F.avg(measured),
            "stddev": F.stddev_samp(measured),
            "min": F.min(measured),
            "max": F.max(measured),
            "min_text": F.min(text),
            "max_text": F.max(text),
        }
        aggregates += [value.alias(f"{name}__{part}") for part, value in parts.items()]
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                *[F.col(f"`{name}__{part}`").alias(part) for part in parts],
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def describe_percentiles(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles of numeric columns.

    Quartiles interpolate linearly between neighbouring values. They are exact by default: the pass
    that takes the other figures sketches the quartiles too, and a second one counts around the
    sketch (see :func:`order_statistics` for more than 20 million rows). ``approximate`` takes one
    pass and returns observed values within 1/10000 of the rank.
    """
    names = list(columns or _numeric_columns(df))
    values = df.select(*[_number(df, name).alias(name) for name in names])
    aggregates = []
    for name in names:
        x = F.col(f"`{name}`")
        aggregates += [
            F.count(x).alias(f"{name}__count"),
            F.avg(x).alias(f"{name}__mean"),
            F.stddev_samp(x).alias(f"{name}__std"),
            F.min(x).alias(f"{name}__min"),
            F.max(x).alias(f"{name}__max"),
            (F.percentile_approx(x, list(QUARTILES), 10_000) if approximate else sketch(x, QUARTILES)).alias(
                f"{name}__quartiles"
            ),
        ]
    row = values.agg(*aggregates).first()
    sizes = {name: row[f"{name}__count"] for name in names}
    sketched = {name: row[f"{name}__quartiles"] for name in names}
    if approximate:
        quartiles = {name: sketched[name] or [None] * 3 for name in names}
    else:
        quartiles = _exact_quartiles(values, sizes, sketched)
    table = [
        (
            name,
            *[row[f"{name}__{part}"] for part in ("count", "mean", "std", "min")],
            *quartiles[name],
            row[f"{name}__max"],
        )
        for name in names
    ]
    schema = (
        "column string, count bigint, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double"
    )
    return df.sparkSession.createDataFrame(table, schema)


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, row count and non-missing count per column; NaN counts as missing."""
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    rows = []
    for field in df.schema.fields:
        x = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            x = F.when(~F.isnan(x), x)
        aggregates.append(F.count(x).alias(f"{field.name}__present"))
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("__rows").alias("rows"),
                F.col(f"`{field.name}__present`").alias("non_null"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, column: str, bins: int = 30, most_bins: int = MOST_BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty ones kept.

    The counts of all bins are broadcast; ``most_bins`` is the bound of that.

    A column with a single value is given the range value ± 0.5. A value whose computed bin
    disagrees with that bin's edges is moved to the neighbour.
    """
    if not 0 < bins <= most_bins:
        raise ValueError(f"bins must be between 1 and {most_bins}")
    values = df.select(_number(df, column).alias("x"))
    span = values.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    schema = "bin bigint, left double, right double"
    if span.low is None:
        return df.sparkSession.createDataFrame([], schema + ", count bigint")
    low, high = (span.low, span.high) if span.low < span.high else (span.low - 0.5, span.low + 0.5)
    width = (high - low) / bins
    guess = F.floor((F.col("x") - low) / width)
    guess = F.when(guess < bins, guess).when(F.col("x").isNotNull(), bins - 1)
    left, right = low + F.col("bin") * width, low + (F.col("bin") + 1) * width
    step = (
        F.when(F.col("x") < left, -1)
        .when((F.col("x") >= right) & (F.col("bin") < bins - 1), 1)
        .otherwise(0)
    )
    # Missing values get a bin of their own: were the bin nullable, the join below would push a null
    # test, and with it a second evaluation of the measured expression, down to the scan.
    bin_number = F.coalesce(F.col("bin") + step, F.lit(-1).cast("bigint"))
    placed = values.withColumn("bin", guess).select(bin_number.alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("count"))
    edges = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    grid = edges.select("bin", left.alias("left"), right.alias("right"))
    # One row per bin at most, plus one for missing values.
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", "left", "right", F.coalesce("count", F.lit(0)).alias("count")
    )


def _exact_quartiles(
    values: DataFrame, sizes: dict[str, int], sketched: dict[str, list[float]]
) -> dict[str, list[float | None]]:
    ranks: dict[str, dict[int, tuple[float, float]]] = {}
    for name, size in sizes.items():
        if size:
            ranks[name] = {}
            for i, share in enumerate(QUARTILES):
                place = share * (size - 1)
                for rank in (math.floor(place), math.ceil(place)):
                    ranks[name].setdefault(rank, tuple(sketched[name][2 * i : 2 * i + 2]))
    found = order_statistics(values, {n: sorted(r) for n, r in ranks.items()}, sizes, sketches=ranks)
    quartiles: dict[str, list[float | None]] = {}
    for name, size in sizes.items():
        quartiles[name] = []
        for share in QUARTILES:
            if not size:
                quartiles[name].append(None)
                continue
            place = share * (size - 1)
            lower = found[name, math.floor(place)].value
            upper = found[name, math.ceil(place)].value
            quartiles[name].append(lower + (upper - lower) * (place - math.floor(place)))
    return quartiles


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _number(df: DataFrame, name: str) -> Column:
    """The column as double, NaN as null."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)
