"""Nearest neighbours by few stable projections in a kd-tree, with a chi-square stopping test.

Largest inner product becomes smallest Euclidean distance when every vector gets one more entry
that makes all norms equal. Vectors are then projected on a few Gaussian directions: the squared
projected distance over the squared true one follows a chi-square law with as many degrees of
freedom. A kd-tree holds the projections of a block of rows. Its leaves are taken by rising
projected distance to the query and their rows verified by true inner products; a query stops when
a row as near as its k-th best would, with the given probability, have been met by now.

Rows are dealt into blocks of bounded size by a hash of their id, and so are the queries; each
pair of blocks is searched on its own and the best of all blocks are ranked. Every row is indexed,
nothing is sampled, and equal or very common vectors spread over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Degrees of freedom; an even number, for which the chi-square law has a closed form.
PROJECTIONS = 8
#: Probability at which a query stops, rows of a leaf, rows and queries of a block.
CONFIDENCE, LEAF, BLOCK_ROWS, QUERY_ROWS = 0.98, 64, 8192, 4096
SEED = 77
#: Projected distances below this share of the largest squared norm are taken for none.
ROUNDING = 1e-20
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """False for a vector that is null, zero, or holds a null or non-finite component."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def chi_square(x: np.ndarray, freedom: int) -> np.ndarray:
    """Distribution function of the chi-square law for an even number of degrees of freedom."""
    half = np.asarray(x) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, freedom // 2):
        term = term * half / i
        total = total + term
    with np.errstate(over="ignore", invalid="ignore"):
        value = 1 - np.exp(-half) * total
    return np.where(np.isfinite(half), value, 1.0)


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of each leaf: halves at the median of the widest side, until a leaf is small enough."""
    out, open_nodes = [], [np.arange(len(points))]
    while open_nodes:
        rows = open_nodes.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = points[rows]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        half = len(rows) // 2
        split = np.argpartition(own[:, side], half)
        open_nodes += [rows[split[half:]], rows[split[:half]]]
    return out


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner product of each row with the other side's, added up from the first component to the last.

    A matrix product adds in an order that follows from the shapes, so equal vectors could get
    scores that differ in the last bit, and ties would not be ties.
    """
    total = np.zeros(len(left))
    for x, y in zip(left.T, right.T, strict=True):
        total += x * y
    return total


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
    k: int, confidence: float = CONFIDENCE, projections: int = PROJECTIONS, leaf: int = LEAF, seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and inner products of each query's best rows; -inf where there are fewer than k."""
    width, n = vectors.shape[1], len(queries)
    directions = np.random.default_rng([seed, width]).standard_normal((width + 1, projections))
    squares = np.einsum("ij,ij->i", vectors, vectors)
    top_square = squares.max()
    last = np.sqrt(np.maximum(top_square - squares, 0))
    points = vectors @ directions[:-1] + last[:, None] * directions[-1]
    leaves = kd_leaves(points, leaf)
    low = np.stack([points[rows].min(axis=0) for rows in leaves])
    high = np.stack([points[rows].max(axis=0) for rows in leaves])
    asked = queries @ directions[:-1]
    reach = np.empty((n, len(leaves)))
    for j in range(len(leaves)):
        gap = np.maximum(np.maximum(low[j] - asked, asked - high[j]), 0)
        reach[:, j] = np.einsum("ij,ij->i", gap, gap)
    # projections of equal vectors may differ in the last bits
    reach[reach < ROUNDING * top_square] = 0.0
    order = np.argsort(reach, axis=1, kind="stable")
    query_squares = np.einsum("ij,ij->i", queries, queries)
    # more than two sums of ``width`` products in any order can differ by
    slack = 4 * width * np.finfo(np.float64).eps * np.sqrt(query_squares * top_square)
    best = np.full((n, k), -np.inf)
    names = np.full((n, k), np.iinfo(np.int64).max)
    active = np.arange(n)
    for turn in range(len(leaves)):
        next_leaf = order[active, turn]
        if turn:
            r = reach[active, next_leaf]
            d = query_squares[active] + top_square - 2 * best[active, k - 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(d > 0, r / d, np.where(r > 0, np.inf, 0.0))
            active = active[chi_square(ratio, projections) < confidence]
            next_leaf = order[active, turn]
        if not len(active):
            break
        by_leaf = np.argsort(next_leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(next_leaf[by_leaf])) + 1
        for part in np.split(by_leaf, cuts):
            rows, who = leaves[next_leaf[part[0]]], active[part]
            # the matrix product only tells who may be among the best, within its rounding
            near = queries[who] @ vectors[rows].T >= (best[who, k - 1] - slack[who])[:, None]
            near &= ids[rows][None, :] != query_ids[who][:, None]
            some = np.flatnonzero(near.any(axis=1))
            if not len(some):
                continue
            who, near = who[some], near[some]
            scores = np.full(near.shape, -np.inf)
            i, j = np.nonzero(near)
            scores[i, j] = inner_products(queries[who[i]], vectors[rows[j]])
            found = np.broadcast_to(ids[rows], scores.shape)
            scores = np.concatenate([best[who], scores], axis=1)
            found = np.concatenate([names[who], found], axis=1)
            keep = np.lexsort((found, -scores), axis=-1)[:, :k]
            best[who] = np.take_along_axis(scores, keep, axis=1)
            names[who] = np.take_along_axis(found, keep, axis=1)
    return names, best


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.float64())
    return np.asarray(flat, dtype=np.float64).reshape(-1, width)


def searcher(k: int, confidence: float, projections: int, leaf: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        width = asked["width"][0].as_py()
        query_ids, ids = np.asarray(asked["id"]), np.asarray(held["id"])
        names, best = search_block(
            query_ids, _matrix(asked["vector"], width), ids, _matrix(held["vector"], width),
            k, confidence, projections, leaf,
        )
        real = best > -np.inf
        return pa.table(
            [np.repeat(query_ids, real.sum(axis=1)), names[real], best[real]], schema=schema
        )

    return search


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
    confidence: float = CONFIDENCE, projections: int = PROJECTIONS, leaf: int = LEAF,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k rows of largest inner product found.

    Ranks start at 1; equal scores go by smaller id. Unusable vectors and rows with a null id take
    no part on either side; vectors of another width than the query's are no candidates, nor are
    rows with the query's own id. Ids should be unique: rows that share one are ranked one by one.
    Other columns are not carried; empty tables give no rows.
    """
    if k < 1 or projections < 2 or projections % 2:
        raise ValueError("k from 1, an even number of projections from 2")

    def slim(df: DataFrame) -> DataFrame:
        value = F.col(f"`{vector}`")
        good = df.filter(usable(value) & F.col(f"`{key}`").isNotNull())
        return good.select(F.col(f"`{key}`").cast("long").alias("id"), value.cast("array<double>").alias("vector"),
                           F.size(value).alias("width"))

    held, asked = slim(vectors), slim(queries)
    blocks = max(1, math.ceil(held.count() / block_rows))
    parts = max(1, math.ceil(asked.count() / query_rows))

    def deal(df: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )

    keys = ["block", "part", "width"]
    left = deal(asked, "part", parts, "block", blocks).groupBy(*keys)
    right = deal(held, "block", blocks, "part", parts).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(searcher(k, confidence, projections, leaf), FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
