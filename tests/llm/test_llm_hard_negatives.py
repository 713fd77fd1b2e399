import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import hard_negatives as H


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """(anchor, positive, rank, negative, scores) of (id, label, vector) rows by Python integers."""
    good = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    done = set()
    for a, own, va in good:
        if not is_anchor(a) or (a, own, *va) in done:
            continue
        done.add((a, own, *va))
        scored = [(sum(x * y for x, y in zip(va, v, strict=True)), i, label) for i, label, v in good if i != a and len(v) == len(va)]
        best = sorted((-s, i) for s, i, label in scored if label == own)[:positives]
        for negative_score, positive in dict.fromkeys(best):
            p = -negative_score
            near = sorted((-s, i) for s, i, label in scored if label != own and low * p <= 100 * s <= high * p)
            out += [(a, positive, k + 1, i, p, -s) for k, (s, i) in enumerate(near[:negatives])]
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").repartition(5)
    found = H.mine_negatives(df.withColumn("rank", F.lit("x")), F.col("vec_id") % 100 == 0, **settings)
    return sorted(tuple(r) for r in found.collect())


def hundred(i):
    return i % 100 == 0


def some_rows(n, width, seed, size=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width))
    return [(k, int(k % 4), [float(x) for x in size * (centres[k % 3] + 0.7 * rng.standard_normal(width))]) for k in range(n)]


@pytest.mark.parametrize("size", [0.01, 1.0, 1e6, 1e9])
def test_mining_equals_brute_force_over_many_blocks(spark, size):
    rows = some_rows(900, 6, 1, size)
    expected = brute(rows, hundred)
    inside = [r for r in expected if abs(r[4]) < 2**63]
    got = mined(spark, rows, block_rows=100, anchor_rows=3)
    if size < 1e9:
        assert len(inside) == len(expected)
    else:  # scores of some 70 bits are held at the ends of 64
        assert all(-(2**63) <= r[4] < 2**63 for r in got)
        return
    assert got == expected and len(got) > 50
    assert mined(spark, rows) == got


def test_awkward_rows(spark):
    rows = some_rows(250, 5, 2)
    rows += [(1000 + k, 2, [0.5, 0.0, 0.0, 0.0, 0.0]) for k in range(150)]  # one very common vector
    rows += [(2000 + k, 1, [0.3, 0.0, 0.0, 0.0, 0.0]) for k in range(150)]
    rows += [(3000, None, [1.0] * 5), (3100, 1, None), (3200, 1, [1.0, None, 1.0, 1.0, 1.0]), (3300, 1, [math.nan] * 5),
             (3400, 1, [math.inf] * 5), (None, 1, [1.0] * 5), (3500, 1, []), (3501, 1, []), (3502, 2, []), (3600, 3, [1.0, 2.0]),
             (3700, 0, [0.0] * 5), (3800, 7, [1.0, 1.0, 1.0, 1.0, 1.0]), (-100, 0, [-0.2, 0.1, 0.0, 0.0, 0.0])]
    expected = brute(rows, hundred)
    assert mined(spark, rows, block_rows=64, anchor_rows=2) == expected
    assert {r[0] for r in expected} > {1000, 1100, 2000}
    own = [r for r in expected if r[0] == 1000 and r[1] == 1001]
    assert [r[3] for r in own] == sorted(r[3] for r in own) or len({r[5] for r in own}) > 1
    assert mined(spark, []) == []
    repeated = [*rows, *rows[:120], *rows[250:260], *rows[:3]]  # rows that occur two and three times
    assert mined(spark, repeated, block_rows=64, anchor_rows=2) == brute(repeated, hundred) != expected
    with pytest.raises(ValueError):
        mined(spark, rows, positives=0)


def test_packed_products_are_exact():
    rng = random.Random(5)
    for width, size in ((1, 1), (64, 300), (64, 2**20), (7, 2**31), (3, 2**60), (0, 1)):
        numbers = np.array([[rng.randint(-size, size) for _ in range(width)] for _ in range(50)], dtype=object).reshape(50, width)
        if size < 2**31:
            numbers = numbers.astype(np.int64)
        block = H.PackedBlock(np.arange(50), np.zeros(50), numbers)
        for anchor in numbers[:5]:
            exact = [sum(int(x) * int(y) for x, y in zip(anchor, row, strict=True)) for row in numbers]
            held = [min(max(x, -(2**63)), 2**63 - 1) for x in exact]
            assert block.scores(anchor).tolist() == held


def test_fields_hold_the_largest_sum():
    assert H.field_bytes(64, 512, 512) == 4 and H.field_bytes(64, 2**13, 2**13) == 4 + 4
    top = 2**13 - 1
    block = H.PackedBlock(np.arange(3), np.zeros(3), np.array([[0] * 64, [top] * 64, [0] * 64]))
    assert block.scores(np.array([top] * 64)).tolist() == [0, 64 * top * top, 0]


def test_whole_numbers_are_floors():
    x = np.array([[0.5, -0.001, 3e300, -1e308, 2.0**-1074]])
    assert H.whole_numbers(x).tolist() == [[math.floor(256 * v) if abs(v) < 1e305 else 256 * int(v) for v in x[0].tolist()]]
    assert H.band(-5) == (-1, -5) and H.band(7) == (3, 6) and H.band(0) == (0, 0)
