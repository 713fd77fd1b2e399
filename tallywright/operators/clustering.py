"""Lloyd's k-means from given seeds."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions.numeric import finite
from tallywright.functions.vectors import UNROLL_LIMIT, nearest_arrow, with_nearest_unrolled
from tallywright.operators.many_centroids import assign_nearest_many
from tallywright.sources.points import CENTROID_SCHEMA, MAX_CENTROIDS, centroid_rows

Centroids = list[tuple[int, list[float]]]
Features = str | Sequence[str]


def split_valid_points(
    points: DataFrame, features: Features, width: int
) -> tuple[DataFrame, DataFrame]:
    """Points with exactly ``width`` finite coordinates, and all others.

    A point that is too wide, too narrow, malformed, NaN or infinite has no meaningful nearest
    centroid; it is set apart rather than put in a cluster of its own.
    """
    valid = _valid(features, width)
    return points.filter(valid), points.filter(~valid)


def _valid(features: Features, width: int) -> Column:
    if isinstance(features, str):
        sized = F.coalesce(F.size(features) == width, F.lit(False))
        return sized & F.coalesce(F.forall(features, finite), F.lit(False))
    valid = F.lit(len(features) == width)
    for name in features:
        valid = valid & finite(F.col(name))
    return valid


def assign_nearest(
    points: DataFrame,
    centroids: DataFrame | Centroids,
    features: Features = "x",
    most_literal: int = MAX_CENTROIDS,
) -> DataFrame:
    """Add ``cid``, the nearest centroid by squared Euclidean distance, ties to the lowest id.

    ``features`` is one array column or a list of number columns; a point that is not valid (see
    :func:`split_valid_points`) gets null. There is no join and no shuffle: the centroids are
    literals of the plan. A table of more than ``most_literal`` centroids stays a table, and points
    meet the groups of centroids that can be nearest (:func:`assign_nearest_many`).
    """
    if isinstance(centroids, DataFrame):
        first = centroids.select(F.size("c").alias("width")).limit(most_literal + 1).collect()
        if len(first) > most_literal:
            x = F.col(features) if isinstance(features, str) else F.array(*features)
            return assign_nearest_many(points, centroids, x, _valid(features, first[0]["width"]))
    rows = _rows(centroids)
    width = _width(rows)
    if width * len(rows) <= UNROLL_LIMIT:
        return with_nearest_unrolled(
            points, _coordinates(features, width), rows, _valid(features, width)
        )
    x = F.col(features) if isinstance(features, str) else F.array(*features)
    return points.withColumn("cid", nearest_arrow(x, rows))


def recompute_centroids(assigned: DataFrame, features: Features = "x", width: int = 2) -> DataFrame:
    """Mean point and size per cluster, combined on the map side: k rows leave each task."""
    means = [F.avg(x).alias(f"__m{i}") for i, x in enumerate(_coordinates(features, width))]
    grouped = assigned.groupBy("cid").agg(*means, F.count("*").alias("size"))
    return grouped.select("cid", F.array(*[f"__m{i}" for i in range(width)]).alias("c"), "size")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Points per cluster."""
    return assigned.groupBy("cid").agg(F.count("*").alias("size"))


@dataclass
class KMeansResult:
    """Final centroids, and those after every iteration."""

    spark: SparkSession
    centroids: Centroids
    steps: list[tuple[int, int, list[float], int, float]] = field(default_factory=list)
    milliseconds: list[int] = field(default_factory=list)
    bad_points: DataFrame | None = None

    def bad_count(self) -> int:
        """Input rows that took no part because they are no valid points."""
        return self.bad_points.count() if self.bad_points is not None else 0

    def centroid_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.centroids, CENTROID_SCHEMA)

    def history(self) -> DataFrame:
        """``(iteration, cid, c, size, shift)``; shift is the distance moved in the iteration."""
        schema = "iteration int, cid int, c array<double>, size bigint, shift double"
        return self.spark.createDataFrame(self.steps, schema)

    def timings(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(enumerate(self.milliseconds)), "iteration int, milliseconds bigint"
        )


def kmeans_fit(
    points: DataFrame,
    seeds: DataFrame | Centroids,
    max_iter: int = 15,
    features: Features = "x",
    empty: str = "drop",
    tol: float | None = None,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> KMeansResult:
    """Repeat assignment and mean a fixed number of times; with ``tol`` stop at a smaller shift.

    ``empty='drop'`` removes a cluster that lost its points and leaves the other ids alone;
    ``empty='keep'`` carries its centroid on. Invalid points take no part; the result's
    ``bad_points`` has their rows. Between iterations only
    the k centroids live on the driver, so the plan does not grow and a lost executor costs no
    more than its cached blocks, which are rebuilt from the source. Pass ``storage=None`` where the
    input is columnar already and larger than the cluster's caches.
    """
    if empty not in {"drop", "keep"}:
        raise ValueError("empty must be 'drop' or 'keep'")
    rows = _rows(seeds)
    width = _width(rows)
    valid, bad = split_valid_points(points, features, width)
    valid = valid.select(*([features] if isinstance(features, str) else features))
    if storage is not None:
        valid = valid.persist(storage)
    result = KMeansResult(points.sparkSession, rows, bad_points=bad)
    try:
        for iteration in range(max_iter):
            started = time.monotonic()
            assigned = assign_nearest(valid, rows, features)
            means = recompute_centroids(assigned, features, width).collect()
            rows = _next_step(result, iteration, rows, {m.cid: (m.c, m.size) for m in means}, empty)
            result.milliseconds.append(round((time.monotonic() - started) * 1000))
            if tol is not None and max(s[4] for s in result.steps[-len(rows):]) < tol:
                break
    finally:
        if storage is not None:
            valid.unpersist()
    result.centroids = rows
    return result


def kmeans_history(
    points: DataFrame, seeds: DataFrame | Centroids, max_iter: int = 15, **options: object
) -> DataFrame:
    """Centroids after each iteration."""
    return kmeans_fit(points, seeds, max_iter, **options).history()


def _next_step(
    result: KMeansResult,
    iteration: int,
    rows: Centroids,
    means: dict[int, tuple[list[float], int]],
    empty: str,
) -> Centroids:
    if not means:
        raise ValueError("no valid points")
    following: Centroids = []
    for cid, old in rows:
        if cid not in means and empty == "drop":
            continue
        centre, size = means.get(cid, (old, 0))
        result.steps.append((iteration, cid, list(centre), size, math.dist(centre, old)))
        following.append((cid, list(centre)))
    return following


def _rows(centroids: DataFrame | Centroids) -> Centroids:
    rows = centroid_rows(centroids) if isinstance(centroids, DataFrame) else sorted(centroids)
    if not rows:
        raise ValueError("no centroids")
    return rows


def _width(rows: Centroids) -> int:
    widths = {len(centre) for _, centre in rows}
    if len(widths) != 1:
        raise ValueError(f"centroids differ in width: {sorted(widths)}")
    return widths.pop()


def _coordinates(features: Features, width: int) -> list[Column]:
    if isinstance(features, str):
        return [F.get(features, F.lit(i)) for i in range(width)]
    if len(features) != width:
        raise ValueError("centroids and feature columns differ in width")
    return [F.col(name) for name in features]
