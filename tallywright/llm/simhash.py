"""SimHash near-duplicates: 64-bit fingerprints, compared exactly in tiles.

Distinct fingerprints are grouped by their population counts, one count for each quarter of the
bits, and each group is cut into tiles. The population counts of two fingerprints differ, summed
over the quarters, by no more than their distance, so a pair of tiles is compared only if its
counts differ by the radius or less; every such pair is, by numpy exclusive-or and bit counts. Of
the links found in a pair of tiles a spanning forest is kept, so a group of n linked fingerprints
gives fewer than n rows and none of its connections is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.components import connected
from tallywright.llm.text_units import spare_name
from tallywright.session import materialize

SHINGLE_WORDS, RADIUS, HASH_SEED = 3, 2, 42
#: Fingerprints in a tile, and comparisons made at once.
TILE, BLOCK = 512, 1 << 20
QUARTERS = 4
#: Values of one quarter's population count, and so at most PLACES ** QUARTERS tile groups.
PLACES = 64 // QUARTERS + 1
#: Shingles whose bits are summed at once.
SUM_SHINGLES = 50_000
#: Parts that the rows of one fingerprint are dealt into.
SALTS = 16


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned XXH64 of the space-joined shingles of a text, repeats included."""
    found = text.encode().lower().split()  # bytes: lower-cases A-Z and splits at ASCII blanks only
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    if len(found) <= words:
        parts = [joined] if found else []
    else:
        starts = np.concatenate([[0], ends[:-1] + 1])
        last = words - 1
        parts = [joined[s:e] for s, e in zip(starts[:-last or None].tolist(), ends[last:].tolist(), strict=True)]
    return np.fromiter((xxhash.xxh64_intdigest(p, HASH_SEED) for p in parts), dtype=np.uint64, count=len(parts))


def fingerprints(texts: list[str | None], words: int = SHINGLE_WORDS) -> np.ndarray:
    """One fingerprint per text: the bits set in over half of its hashes; 0 for no words."""
    out = np.zeros(len(texts), dtype=np.uint64)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if waiting:
            starts = np.cumsum([0] + [len(h) for _, h in waiting[:-1]])
            hashes = np.concatenate([h for _, h in waiting])
            sums = np.add.reduceat(bits_of(hashes), starts, axis=0, dtype=np.int64)
            counts = np.array([len(h) for _, h in waiting])
            out[[row for row, _ in waiting]] = number_of(2 * sums > counts[:, None])
            waiting.clear()

    for row, text in enumerate(texts):
        hashes = shingle_hashes(text or "", words)
        if len(hashes) > SUM_SHINGLES:
            sums = sum(
                bits_of(hashes[k : k + SUM_SHINGLES]).sum(axis=0, dtype=np.int64)
                for k in range(0, len(hashes), SUM_SHINGLES)
            )
            out[row] = number_of((2 * sums > len(hashes))[None, :])[0]
        elif len(hashes):
            waiting.append((row, hashes))
            size += len(hashes)
            if size > SUM_SHINGLES:
                flush()
                size = 0
    flush()
    return out


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def number_of(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def with_fingerprint(docs: DataFrame, text: str, out: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint as a signed long; the text column is not carried."""
    own = spare_name(docs, "text")
    slim = docs.withColumn(own, F.col(f"`{text}`").cast("string")).drop(text)
    schema = slim.drop(own).schema.add(out, "long")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            marks = fingerprints(batch.column(last).to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(last)], pa.array(marks)], names=schema.names
            )

    return slim.mapInArrow(add, schema)


def forest(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles; ``same`` if they are one tile."""
    n = len(left)
    root = np.arange(n if same else n + len(right))
    a, b = [], []
    rows = max(1, BLOCK // max(len(right), 1))
    for low in range(0, n, rows):
        near = np.bitwise_count(left[low : low + rows, None] ^ right[None, :]) <= radius
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(low, min(low + rows, n))[:, None]
        for k in np.flatnonzero(near.any(axis=1)):
            i = low + int(k)
            linked = np.flatnonzero(near[k])
            roots, first = np.unique(root[linked if same else linked + n], return_index=True)
            new = roots != root[i]
            if new.any():
                a += [left[i]] * int(new.sum())
                b += right[linked[first[new]]].tolist()
                root[np.isin(root, roots[new])] = root[i]
    return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)


def compare_tiles(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of each row's pair of tiles (left, right: fingerprints; same: one tile)."""
    for batch in batches:
        left, right, same = (batch.column(i) for i in range(3))
        for k in range(batch.num_rows):
            x, y = (np.asarray(side[k].values).view(np.uint64) for side in (left, right))
            a, b = forest(x, y, radius, same[k].as_py())
            if len(a):
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def quarter_counts(mark: Column) -> list[Column]:
    width = 64 // QUARTERS
    return [
        F.bit_count(F.shiftrightunsigned(mark, k * width).bitwiseAND(F.lit((1 << width) - 1))).cast("int")
        for k in range(QUARTERS)
    ]


def links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints (column ``mark``) at the radius or less.

    The count of each tile group is joined back, to cut groups into tiles and to list the tiles of
    the groups nearby; there are at most 17 ** 4 = 83,521 groups, 1.3 MB, which is the bound of
    those broadcasts.
    """
    names = [f"c{k}" for k in range(QUARTERS)]
    counted = marks.select("mark", *[c.alias(n) for c, n in zip(quarter_counts(F.col("mark")), names, strict=True)])
    sizes = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.join(F.broadcast(sizes), names)
    tile = F.pmod(F.xxhash64("mark"), F.ceil(F.col("n") / TILE)).alias("tile")
    tiles = materialize(
        dealt.groupBy(*names, tile).agg(F.sort_array(F.collect_list("mark")).alias("marks")), "tiles"
    )
    # of the differences of two counts only those whose first entry other than 0 is positive, so
    # that a pair of tiles meets once
    steps = [
        step
        for step in product(range(-radius, radius + 1), repeat=QUARTERS)
        if sum(map(abs, step)) <= radius and next((s for s in step if s), 0) >= 0
    ]
    near = F.array(*[F.struct(*[F.lit(s).alias(n) for s, n in zip(step, names, strict=True)]) for step in steps])
    left = tiles.select(
        *[F.col(n).alias(f"from_{n}") for n in names], F.col("tile").alias("from_tile"),
        F.col("marks").alias("left"), F.explode(near).alias("step"),
    )
    inside = F.lit(True)
    for n in names:
        left = left.withColumn(n, F.col(f"from_{n}") + F.col("step")[n])
        inside = inside & F.col(n).between(0, PLACES - 1)
    # a pair of tiles is a key of its own, so a large group is compared by as many tasks as it has tiles
    counts = sizes.select(*names, F.ceil(F.col("n") / TILE).alias("tiles"))
    aimed = left.filter(inside).drop("step").join(F.broadcast(counts), names)
    aimed = aimed.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    pairs = aimed.join(tiles.withColumnRenamed("marks", "right"), [*names, "tile"])
    home = F.lit(True)
    for n in names:
        home = home & (F.col(n) == F.col(f"from_{n}"))
    pairs = pairs.filter(~home | (F.col("from_tile") <= F.col("tile")))
    pairs = pairs.select("left", "right", (home & (F.col("from_tile") == F.col("tile"))).alias("same"))
    return pairs.mapInArrow(lambda batches: compare_tiles(batches, radius), "a long, b long")


def cluster(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row (key, mark, component_id) per row of the table.

    ``mark`` is the fingerprint as a signed long; ``component_id`` the smallest key among the rows
    reachable over links, the row's own included. A null text counts as empty; texts without words
    have fingerprint 0 and are linked by it like any other. Equal texts are compared once. A null
    key is no candidate for ``component_id`` unless its component has no other.
    """
    marked = with_fingerprint(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), text, "mark", words)
    marked = materialize(marked, "fingerprints")
    marks = materialize(marked.groupBy("mark").agg(F.min(key).alias("least")), "marks")
    edges = materialize(links(marks.select("mark"), radius), "links")
    roots = connected(edges)
    rooted = marks.join(roots.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "root", F.coalesce("root", "mark")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("mark", "component_id"), "components")
    # a fingerprint that very many rows share meets its component in many tasks
    salt = spare_name(marked, "salt")
    parts = named.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    dealt = marked.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(SALTS)))
    return dealt.join(parts, ["mark", salt]).select(key, "mark", "component_id")


def hex_mark(mark: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(mark), 16, "0"))
