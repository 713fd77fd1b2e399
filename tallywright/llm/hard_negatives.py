"""Hard negatives by exact inner products of whole numbers, many at once in one wide integer.

The components of a block of rows are biased to be no less than zero and set side by side, one
field for each row, into one wide integer for each component. A field has room for the largest sum
that can arise, so nothing carries over. Multiplying such an integer by an anchor's biased
component and adding the products up gives the anchor's inner products with all rows of the block,
each in its own field; taking the biases out again gives exact scores.

Blocks of rows meet blocks of anchors, twice: once for each anchor's positives, and once, with the
positives known, for the rows of other labels within each positive's band. A pair of blocks hands
on only as many rows for each anchor as are asked for in all.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.session import materialize

#: Positives of an anchor, negatives of a positive, and their band in hundredths of its score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: A component is the floor of its product with the scale.
SCALE = 256
#: Rows and anchors of a block.
BLOCK_ROWS, ANCHOR_ROWS = 8192, 4096
LONG = np.iinfo(np.int64)

FOUND = "anchor_id long, other_id long, score long"
MINED = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def usable(vector: Column) -> Column:
    """False for a vector that is null or holds a null or non-finite component."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(vectors: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """Floors of the scaled components; Python integers where they do not fit 32 bits."""
    with np.errstate(over="ignore"):
        floors = np.floor(scale * vectors)
    if floors.size == 0 or np.abs(floors).max() < 2**31:
        return floors.astype(np.int64)
    flat = [math.floor(scale * x) if math.isfinite(scale * x) else int(scale) * int(x) for x in vectors.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(vectors.shape)


def field_bytes(width: int, top_anchor: int, top_row: int) -> int:
    """Bytes of a field that holds a sum of ``width`` products; 4, 8 or a multiple of 8."""
    bits = max(1, (width * top_anchor * top_row).bit_length())
    return 4 if bits <= 32 else 8 * math.ceil(bits / 64)


def pack_fields(column: np.ndarray, size: int) -> int:
    """Numbers from zero up, side by side in fields of ``size`` bytes, the first one lowest."""
    if column.dtype != object and size in (4, 8):
        return int.from_bytes(column.astype(f"<u{size}").tobytes(), "little")
    return int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in column), "little")


def unpack_fields(packed: int, rows: int, size: int) -> np.ndarray:
    raw = packed.to_bytes(rows * size, "little")
    if size in (4, 8):
        return np.frombuffer(raw, dtype=f"<u{size}")
    return np.array([int.from_bytes(raw[k : k + size], "little") for k in range(0, rows * size, size)], dtype=object)


class PackedBlock:
    """The rows of a block, ready to be multiplied by anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray) -> None:
        self.ids, self.labels = ids, labels
        self.rows, self.width = numbers.shape
        self.low = int(numbers.min()) if numbers.size else 0
        biased = numbers - self.low
        self.top = int(biased.max()) if numbers.size else 0
        self.sums = biased.sum(axis=1)
        self.biased = biased
        self.packed: dict[int, list[int]] = {}

    def fields(self, size: int) -> list[int]:
        if size not in self.packed:
            self.packed[size] = [pack_fields(self.biased[:, j], size) for j in range(self.width)]
        return self.packed[size]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products with one anchor's whole numbers, held at the ends of 64 bits."""
        numbers = [int(x) for x in anchor]
        bias = min(numbers, default=0)
        raised = [x - bias for x in numbers]
        size = field_bytes(self.width, max(raised, default=0), self.top)
        total = 0
        for number, fields in zip(raised, self.fields(size), strict=True):
            total += number * fields
        products = unpack_fields(total, self.rows, size)
        # sum (a' + bias)(c' + low) = sum a'c' + bias sum c' + low sum a
        constant = self.low * sum(numbers)
        reach = self.width * self.top * (max(raised, default=0) + abs(bias)) + abs(constant)
        if products.dtype != object and self.sums.dtype != object and reach < LONG.max:
            return products.astype(np.int64) + bias * self.sums.astype(np.int64) + constant
        exact = [int(p) + bias * int(s) + constant for p, s in zip(products, self.sums, strict=True)]
        return np.array([min(max(x, LONG.min), LONG.max) for x in exact], dtype=np.int64)


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], ~scores[near]))][:k]


def band(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest score of a negative, in whole numbers, for low and high in hundredths."""
    return -((-low * score) // 100), (high * score) // 100


def in_band(order: np.ndarray, scores: np.ndarray, low: int, high: int, k: int) -> np.ndarray:
    """The first k places of ``order``, which falls by score, with scores from low to high."""
    if low > high or low > LONG.max or high < LONG.min:
        return order[:0]
    falling = ~scores[order]
    first = np.searchsorted(falling, ~np.int64(min(high, LONG.max)), side="left")
    last = np.searchsorted(falling, ~np.int64(max(low, LONG.min)), side="right")
    return order[first : min(last, first + k)]


def _matrix(column: pa.ChunkedArray, rows: int, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if rows else pa.array([], pa.float64())
    return np.asarray(flat, dtype=np.float64).reshape(rows, width)


def _block(held: pa.Table, width: int, scale: float) -> PackedBlock:
    numbers = whole_numbers(_matrix(held["vector"], held.num_rows, width), scale)
    return PackedBlock(np.asarray(held["id"]), np.asarray(held["label"]), numbers)


def positives_of(k: int, scale: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best rows of the anchors' own labels in one block."""
    schema = pa.schema([("anchor_id", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        width = asked["width"][0].as_py()
        block = _block(held, width, scale)
        anchors = whole_numbers(_matrix(asked["vector"], asked.num_rows, width), scale)
        own_label = {label: np.flatnonzero(block.labels == label) for label in set(asked["label"].to_pylist())}
        parts = []
        for name, label, vector in zip(asked["id"].to_pylist(), asked["label"].to_pylist(), anchors, strict=True):
            rows = own_label[label]
            rows = rows[block.ids[rows] != name]
            if len(rows):
                scores = block.scores(vector)[rows]
                best = best_rows(scores, block.ids[rows], k)
                parts.append((np.full(len(best), name), block.ids[rows][best], scores[best]))
        if not parts:
            return schema.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*parts, strict=True)], schema=schema)

    return search


def negatives_of(k: int, low: int, high: int, scale: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The first rows of other labels in the band of each of the anchors' positives, in one block."""
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        width = asked["width"][0].as_py()
        block = _block(held, width, scale)
        anchors = whole_numbers(_matrix(asked["vector"], asked.num_rows, width), scale)
        parts = []
        asked_rows = zip(asked["id"].to_pylist(), asked["label"].to_pylist(), asked["positives"].to_pylist(), anchors, strict=True)
        for name, label, positives, vector in asked_rows:
            scores = block.scores(vector)
            known = dict.fromkeys((p["other_id"], p["score"]) for p in positives)
            bands = [(other, score, *band(score, low, high)) for other, score in known]
            top, least = max(b[3] for b in bands), min(b[2] for b in bands)
            rows = np.flatnonzero((block.labels != label) & (scores >= max(least, LONG.min)) & (scores <= min(top, LONG.max)))
            order = rows[np.lexsort((block.ids[rows], ~scores[rows]))]
            for positive, score, least, top in bands:
                found = in_band(order, scores, least, top, k)
                parts.append(
                    (np.full(len(found), name), np.full(len(found), positive), block.ids[found],
                     np.full(len(found), score), scores[found])
                )
        return pa.table([np.concatenate(c) for c in zip(*parts, strict=True)], schema=schema)

    return search


def mine_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: float = SCALE, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows for which ``anchors`` holds are compared with all rows. An anchor's positives are its best
    other rows of its label; for each of them the best rows of other labels are returned whose
    score, times 100, lies between ``low`` and ``high`` times the positive's. Scores are inner
    products of the scaled components' floors, exact; one outside 64 bits is held at their end.
    Ties go to the smaller id; ranks start at 1.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part;
    vectors of another width than the anchor's are not compared with it. Ids should be unique: rows
    that share the anchor's id are no candidates, other rows that share one are ranked one by one,
    and a positive found twice gives its negatives once. Equal anchors count once; different ones
    that share an id and a label are searched with together.
    A positive without any row in its band gives no rows; empty tables give none. Other columns
    are not carried.
    """
    if positives < 1 or negatives < 1 or not 0 <= low <= high:
        raise ValueError("positives and negatives from 1, 0 <= low <= high")
    value, name = F.col(f"`{vector}`"), F.col(f"`{key}`")
    good = rows.filter(usable(value) & name.isNotNull() & F.col(f"`{label}`").isNotNull())
    held = materialize(
        good.select(
            name.cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
            value.cast("array<double>").alias("vector"), F.size(value).alias("width"),
            F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        ),
        "usable-rows",
    )
    size = held.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    blocks, parts = max(1, math.ceil(size["rows"] / block_rows)), max(1, math.ceil(size["anchors"] / anchor_rows))

    def dealt(df: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        return df.withColumn(own, part).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    meet = ["block", "part", "width"]
    candidates = dealt(held.drop("is_anchor"), "block", blocks, "part", parts).groupBy(*meet)
    # columns of their own: rows of one table meet other rows of it
    asked = held.filter("is_anchor").select(*[F.col(c).alias(c) for c in ("id", "label", "vector", "width")])
    asked = asked.dropDuplicates(["id", "label", "vector"])
    near = dealt(asked, "part", parts, "block", blocks).groupBy(*meet)
    found = near.cogroup(candidates).applyInArrow(positives_of(positives, scale), FOUND)
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "other_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    # at most ``positives`` rows for each anchor
    listed = best.groupBy("anchor_id").agg(F.collect_list(F.struct("other_id", "score")).alias("positives"))
    listed = materialize(listed, "positives").withColumnRenamed("anchor_id", "id")
    armed = dealt(asked.join(listed, "id"), "part", parts, "block", blocks).groupBy(*meet)
    mined = armed.cogroup(candidates).applyInArrow(negatives_of(negatives, low, high, scale), MINED)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
