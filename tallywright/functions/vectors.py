"""Nearest-centroid expressions.

Two kernels give the same answer: both add the squares from left to right, and both give null for a
point that is null, of another width, or not finite. With few centroids and few dimensions the distances are unrolled
into plain arithmetic, which stays inside whole-stage codegen. Past some 60 terms the generated
method grows beyond what the JIT compiles and slows down tenfold, and array functions are evaluated
element by element, so an Arrow-batched numpy kernel takes over. Measured on 2 million points: 10
terms 0.60 s against 0.60 s, 64 terms 0.9 s against 0.7 s, 128 terms 9.2 s against 0.7 s.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNROLL_LIMIT = 32


def with_nearest_unrolled(
    df: DataFrame,
    coordinates: Sequence[Column],
    centroids: Sequence[tuple[int, Sequence[float]]],
    valid: Column,
) -> DataFrame:
    """Add ``cid``: one distance column per centroid, then the first that equals the least.

    The distances live in their own projection, which the optimizer leaves alone as each is used
    twice; every distance is computed once per row. Centroids are ordered by id, so a tie goes to
    the lowest id. Where ``valid`` is false the answer is null.
    """
    ordered = sorted(centroids)
    names = [f"__distance_{cid}" for cid, _ in ordered]
    distances = []
    for name, (_, centre) in zip(names, ordered):
        squares = [
            (x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(coordinates, centre)
        ]
        total = squares[0]
        for square in squares[1:]:
            total = total + square
        distances.append(total.alias(name))
    nearest = F.least(*names) if len(names) > 1 else F.col(names[0])
    hit = F.coalesce(
        *[
            F.when(F.col(name) == F.col("__nearest"), F.lit(cid))
            for name, (cid, _) in zip(names, ordered)
        ]
    )
    return (
        df.select("*", *distances)
        .withColumn("__nearest", nearest)
        .withColumn("cid", F.when(valid, hit).cast("int"))
        .drop("__nearest", *names)
    )


def nearest_arrow(x: Column, centroids: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """Nearest id for an ``array<double>`` column, one Arrow batch at a time."""
    ordered = sorted(centroids)
    ids = np.array([cid for cid, _ in ordered], dtype=np.int32)
    centres = np.array([centre for _, centre in ordered], dtype=np.float64)

    @F.arrow_udf("int")
    def nearest(batch: pa.Array) -> pa.Array:
        if len(batch) == 0:
            return pa.array([], type=pa.int32())
        lengths = pc.fill_null(pc.list_value_length(batch), -1).to_numpy(zero_copy_only=False)
        whole = lengths == centres.shape[1]
        flat = batch.filter(pa.array(whole)).flatten().to_numpy(zero_copy_only=False)
        points = flat.reshape(-1, centres.shape[1])
        best = np.full(len(points), np.inf)
        place = np.zeros(len(points), dtype=np.int64)
        for index, centre in enumerate(centres):
            distance = np.zeros(len(points))
            for x, c in zip(points.T, centre, strict=True):  # in the order of the unrolled sum
                distance += (x - c) * (x - c)
            closer = distance < best
            best[closer] = distance[closer]
            place[closer] = index
        valid = whole.copy()
        valid[whole] = np.isfinite(points).all(axis=1)
        out = np.zeros(len(batch), dtype=np.int32)
        out[whole] = ids[place]
        return pa.array(out, mask=~valid)

    return nearest(x)
