"""Nearest centroid where the centroids are too many for the plan or for a task's memory.

Centroids are grouped around pivots, some of themselves. A point's distance to a pivot and the
radius of the pivot's group bound its distance to every centroid of the group, by the triangle
inequality, so most groups cannot hold its nearest centroid. The point meets the centroids of the
others, slice by slice of the groups, and the least distance over the slices is the answer, as exact
as a comparison with all centroids: products of matrices in single precision leave out the centroids
that their error bound rules out, and the few others are compared number by number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.naming import spare_name
from tallywright.session import materialize

#: Most pivots, which every task holds; most points that a task compares, and most numbers in them, or in
#: the centroids it compares them with.
MOST_PIVOTS, TASK_POINTS, TASK_VALUES = 1_000, 50_000, 1 << 22
#: Products made at once; centroids met at once; points for which a further task is worth its start.
BLOCK, STEP, FEW_POINTS = 1 << 20, 512, 250
#: Share by which a bound may be off through rounding; what single and double precision may lose through underflow.
SLACK, LEAST, TINY = 1e-9, 1e-36, 1e-300


def square_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, added up in the order of the dimensions."""
    total = np.zeros((len(points), len(centres)))
    for x, c in zip(points.T, centres.T, strict=True):
        step = x[:, None] - c[None, :]
        total += step * step
    return total


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), dtype=np.float64).reshape(-1, width)


def _grouped(centroids: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``(group, cid, c, reach)``: each centroid with its nearest pivot and the distance to it."""
    width = pivots.shape[1]

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = np.sqrt(square_distances(_matrix(batch.column(1), width), pivots))
            near = distances.argmin(axis=1)
            yield pa.record_batch(
                [pa.array(near), batch.column(0), batch.column(1), pa.array(distances[np.arange(len(near)), near])],
                ["group", "cid", "c", "reach"],
            )

    return centroids.select("cid", "c").mapInArrow(group, "group long, cid long, c array<double>, reach double")


def _off(width: int, unit: float, lengths: np.ndarray) -> np.ndarray:
    """How far squared distances by products may be off; ``lengths`` are those of both sides added up."""
    return 2 * (width + 8) * unit * lengths * lengths


def _reach(part: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least distance that each point may have to the centroids of each group, and a bound of that to its nearest.

    Every pivot is a centroid, so that no point's nearest is farther than a pivot.
    """
    middle = pivots.mean(axis=0)
    x, p = part - middle, pivots - middle
    xx, pp = (x * x).sum(axis=1)[:, None], (p * p).sum(axis=1)[None, :]
    square = xx + pp - 2 * (x @ p.T)
    off = _off(x.shape[1], 2.0**-50, np.sqrt(xx) + np.sqrt(pp) + np.abs(middle).max(initial=0.0)) + TINY
    nearest = np.sqrt(np.maximum(square + off, 0)).min(axis=1) * (1 + SLACK)
    return (np.sqrt(np.maximum(square - off, 0)) - radius) * (1 - SLACK), nearest


def _may_hold(part: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Which groups may hold the nearest centroid of each point."""
    least, most = _reach(part, pivots, radius)
    return least <= most[:, None]


def _candidates(points: DataFrame, pivots: np.ndarray, radius: np.ndarray, slices: np.ndarray | None = None) -> DataFrame:
    """``(row, x, slice)``: every point with each slice of groups that may hold its nearest centroid.

    ``slices`` gives the slice of each group; by default each is its own.
    """
    width = pivots.shape[1]
    names, own = np.unique(np.arange(len(pivots)) if slices is None else slices, return_inverse=True)
    rows, step = max(1, BLOCK // len(pivots)), max(1, TASK_VALUES // max(1, width))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            for low in range(0, len(x), rows):
                may = _may_hold(x[low : low + rows], pivots, radius)
                met = np.stack([may[:, own == k].any(axis=1) for k in range(len(names))], axis=1)
                who, place = np.nonzero(met)
                for first in range(0, len(who), step):  # a vector is copied for each of its slices
                    at = pa.array(who[first : first + step] + low)
                    yield pa.record_batch(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(names[place[first : first + step]])],
                        ["row", "x", "slice"],
                    )

    return points.mapInArrow(spread, "row long, x array<double>, slice long")


def _first_of_equal(c: np.ndarray) -> np.ndarray:
    """The places of the first of each set of equal rows, in their order."""
    rows = np.ascontiguousarray(c + 0.0).view(f"V{c.shape[1] * 8}").ravel()  # -0.0 as 0.0
    return np.sort(np.unique(rows, return_index=True)[1])


def _runs(groups: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Up to ``STEP`` centroids met at once: the first and last of their groups, by place, and of themselves."""
    firsts = np.append(np.flatnonzero(np.diff(groups, prepend=-1)), len(groups))
    at = 0
    while at < len(firsts) - 1:
        last = max(at + 1, int(np.searchsorted(firsts, firsts[at] + STEP, side="right")) - 1)
        for begin in range(firsts[at], firsts[last], STEP):
            yield at, last, begin, min(begin + STEP, firsts[last])
        at = last


def _nearest(pivots: np.ndarray, radius: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Each point's nearest centroid in one slice, the lowest id of equally near ones.

    A point is compared with the groups that may hold its nearest, and has none where none may.
    """
    schema = pa.schema([("row", pa.int64()), ("distance", pa.float64()), ("cid", pa.int64())])
    width, none = pivots.shape[1], np.iinfo(np.int64).max

    def nearest(points: pa.Table, centroids: pa.Table) -> pa.Table:
        if not points.num_rows or not centroids.num_rows:
            return schema.empty_table()
        centroids = centroids.sort_by([("group", "ascending"), ("cid", "ascending")])
        x, c = _matrix(points["x"], width), _matrix(centroids["c"], width)
        kept = _first_of_equal(c)  # equal ones are of one group, where the lowest id comes first
        c, cid, group = c[kept], centroids["cid"].to_numpy()[kept], centroids["group"].to_numpy()[kept]
        groups, runs = np.unique(group), list(_runs(group))
        middle = pivots.mean(axis=0)
        # numbers up to 1, whose squares are in the range of single precision; the error of a difference
        scale = max(np.abs(x - middle).max(), np.abs(c - middle).max()) or 1.0
        shift = 2.0**-50 * width * max(np.abs(x).max(), np.abs(c).max(), np.abs(middle).max()) / scale

        def sides(rows: np.ndarray, first: float) -> tuple[np.ndarray, np.ndarray]:
            near = (rows - middle) / scale
            square = (near * near).sum(axis=1)
            own, one = (square, np.ones(len(rows))) if first < 0 else (np.ones(len(rows)), square)
            return np.column_stack([near * first, own, one]).astype(np.float32), np.sqrt(square)

        right, long = sides(c, -2.0)
        best, found = np.full(len(x), np.inf), np.full(len(x), none)
        rows = max(1, BLOCK // max(len(pivots), STEP))
        for low in range(0, len(x), rows):
            part = x[low : low + rows]
            left, own = sides(part, 1.0)
            least, most = _reach(part, pivots, radius)
            least, most = np.maximum(least[:, groups], 0) / scale, (most / scale) ** 2 * (1 + SLACK)
            waiting: list[tuple[np.ndarray, ...]] = []

            def settle() -> None:
                """Compare what waits number by number."""
                who, which, under = (np.concatenate(each) for each in zip(*waiting, strict=True))
                still = under <= most[who]
                who, which = who[still], which[still]
                total = np.zeros(len(who))
                size = max(1, BLOCK // width)
                for first in range(0, len(who), size):
                    some = slice(first, first + size)
                    for step in (part[who[some]] - c[which[some]]).T:  # in the order of the dimensions
                        total[some] += step * step
                order = np.lexsort((cid[which], total, who))
                order = order[np.flatnonzero(np.diff(who[order], prepend=-1))]
                who, total, ids = who[order], total[order], cid[which[order]]
                at = low + who
                closer = (total < best[at]) | ((total == best[at]) & (ids < found[at]))
                best[at[closer]], found[at[closer]] = total[closer], ids[closer]
                most[who] = np.minimum(most[who], (np.sqrt(total + TINY) / scale) ** 2 * (1 + SLACK) + LEAST)
                waiting.clear()

            for from_group, to_group, begin, end in runs:
                reach = least[:, from_group:to_group].min(axis=1)
                who = np.flatnonzero(reach * reach * (1 - SLACK) <= most)
                if not len(who):
                    continue
                rough = (left if len(who) == len(part) else left[who]) @ right[begin:end].T
                lengths = own[who] + long[begin:end].max()
                off = _off(width, 2.0**-24, lengths) + 4 * shift * (lengths + shift) + LEAST
                nearest_rough = rough.min(axis=1)
                close = np.flatnonzero(nearest_rough - off <= most[who])
                most[who] = np.minimum(most[who], nearest_rough + off)
                row, column = np.nonzero(rough[close] <= (most[who[close]] + off[close])[:, None])
                if len(row):
                    waiting.append((who[close[row]], begin + column, rough[close[row], column] - off[close[row]]))
                if sum(len(each[0]) for each in waiting) > BLOCK:
                    settle()
            if waiting:
                settle()
        met = found < none
        return pa.table([points["row"].filter(pa.array(met)), best[met], found[met]], schema=schema)

    return nearest


def _slices(sizes: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """``(group, slice, cuts)``: small groups share a slice, a large one is cut over several."""
    dealt, at, held = [], 0, 0
    for group, size in sorted(sizes.items()):
        cuts = math.ceil(size / most)
        if held and held + size > most:
            at, held = at + 1, 0
        dealt.append((group, at, cuts))
        at, held = (at + cuts, 0) if cuts > 1 else (at, held + size)
    return dealt


def assign_nearest_many(points: DataFrame, centroids: DataFrame, x: Column, valid: Column) -> DataFrame:
    """Add ``cid``, the nearest of any number of centroids, ties to the lowest id; null if not valid.

    The points are stored with a number each. Only the pivots, no more than ``MOST_PIVOTS``, and two
    numbers for each of them pass through the driver. Parts of the points meet slices of the groups, one
    pair in a task at a time, so a task holds no more than ``TASK_VALUES`` of each, however popular a
    group is or however many groups may hold a point's nearest.
    """
    known = materialize(centroids.select(F.col("cid").cast("long").alias("cid"), "c"), "centroids")
    sizes = known.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("cid").alias("ids"),
        F.min(F.size("c")).alias("least"), F.max(F.size("c")).alias("most"),
    ).first()
    if sizes["ids"] < sizes["rows"]:
        raise ValueError("centroid ids repeat")
    if not sizes["rows"] or sizes["least"] != sizes["most"]:
        raise ValueError("centroids need one width")
    n = min(MOST_PIVOTS, math.ceil(math.sqrt(sizes["rows"])))
    drawn = known.orderBy(F.xxhash64("cid"), "cid").limit(n).collect()
    pivots = np.array([row["c"] for row in drawn], dtype=np.float64).reshape(n, sizes["most"])
    grouped = materialize(_grouped(known, pivots), "grouped-centroids")
    radius = np.full(n, -np.inf)  # a pivot without centroids, the copy of another, has no group
    held = {}
    for row in grouped.groupBy("group").agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("size")).collect():
        radius[row["group"]], held[row["group"]] = row["radius"], row["size"]
    most = max(1, TASK_VALUES // max(1, sizes["most"]))
    dealt = _slices(held, most)
    slices = np.zeros(n, dtype=np.int64)
    for group, first, _ in dealt:
        slices[group] = first
    number = spare_name(points, "number")
    stored = materialize(points.withColumn(number, F.monotonically_increasing_id()), "points")
    asked = stored.filter(valid).select(F.col(number).alias("row"), x.cast("array<double>").alias("x"))
    slots = points.sparkSession.sparkContext.defaultParallelism
    rows = asked.count()
    count = max(first + cuts for _, first, cuts in dealt)
    parts = max(1, math.ceil(rows / min(most, TASK_POINTS)), min(math.ceil(3 * slots / count), rows // FEW_POINTS))
    tasks = parts * count
    # one row for each pivot
    places = points.sparkSession.createDataFrame(dealt, "group long, first long, cuts int")
    cut = (F.col("first") + F.pmod(F.xxhash64("cid"), F.col("cuts"))).alias("slice")
    cuts = places.groupBy(F.col("first").alias("slice")).agg(F.max("cuts").alias("cuts"))
    left = _candidates(asked, pivots, radius, slices).join(F.broadcast(cuts), "slice").select(
        F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.col("slice"), F.col("slice") + F.col("cuts") - 1)).alias("slice"), "row", "x",
    )
    right = grouped.join(F.broadcast(places), "group").select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), cut, "group", "cid", "c"
    )
    found = (
        left.repartition(tasks, "part", "slice").groupBy("part", "slice")
        .cogroup(right.repartition(tasks, "part", "slice").groupBy("part", "slice"))
        .applyInArrow(_nearest(pivots, radius), "row long, distance double, cid long")
    )
    best = found.groupBy("row").agg(F.min(F.struct("distance", "cid")).alias("best"))
    answer = best.select(F.col("row").alias(number), F.col("best.cid").cast("int").alias("cid"))
    kept = [F.col(f"`{c}`") for c in points.columns if c.lower() != "cid"]
    return stored.drop("cid").join(answer, number, "left").select(*kept, "cid")
