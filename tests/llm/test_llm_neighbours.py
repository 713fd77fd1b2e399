import math

import numpy as np
import pytest

from tallywright.llm import neighbours as N
from tallywright.llm.queries import QUERIES


def brute(queries, vectors, k):
    out = {}
    for q, x in queries:
        scored = sorted(((-float(sum_in_order(x, y)), v) for v, y in vectors if v != q and len(y) == len(x)))[:k]
        out[q] = [v for _, v in scored]
    return out


def test_recall_and_scores_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in rows]
    by_id = dict(vectors)
    expected = brute([(v, x) for v, x in vectors if v % 20 == 0], vectors, 20)
    got = {}
    for r in QUERIES["op6_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(np.dot(by_id[r.query_id], by_id[r.vec_id])), abs=1e-12)
    assert set(got) == set(expected)
    hits = 0
    for q, own in got.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21)) and q not in {r.vec_id for r in own}
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(own, own[1:], strict=False))
        hits += len({r.vec_id for r in own} & set(expected[q]))
    assert hits / (20 * len(expected)) >= 0.9


def test_awkward_vectors_ties_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(300)]
    # one very common vector, nearer to itself than any random row is
    rows += [(1000 + i, [5.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(200)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 0.0]), (2003, [math.nan] * 6),
             (2004, [math.inf, 0.0]), (2005, []), (None, [1.0] * 6), (2006, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, rank string")
    good = [(i, np.array(v)) for i, v in rows if i is not None and i < 2000 or i == 2006]
    asked = df.filter("vec_id in (0, 20, 1000, 1100, 2000, 2001, 2006)")
    found = N.nearest(asked, df, 25, confidence=1.0, leaf=8, block_rows=64, query_rows=2)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    expected = brute([(q, x) for q, x in good if q in (0, 20, 1000, 1100, 2006)], good, 25)
    assert got == {q: v for q, v in expected.items() if v}
    assert got[1000] == [*range(1001, 1026)]  # equal scores by id
    assert N.nearest(df.limit(0), df, 5).count() == 0
    assert N.nearest(df, df.limit(0), 5).count() == 0


def test_equal_vectors_come_in_the_order_of_their_ids(spark):
    rng = np.random.default_rng(5)
    same = [float(x) for x in rng.standard_normal(64)]
    rows = [(i, [float(x) for x in 0.1 * rng.standard_normal(64)]) for i in range(300)]
    rows += [(1000 + i, same) for i in range(40)]
    rows += [(2000 + i, [2 * x for x in same] if i % 2 else [x / 3 for x in same]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(7)
    expected = {}
    for q, x in rows:
        scored = [(sum_in_order(x, y), v) for v, y in rows if v != q]
        expected[q] = [v for _, v in sorted((-s, v) for s, v in scored)[:20]]
    for settings in ({}, {"block_rows": 50, "query_rows": 13}, {"leaf": 4}):
        got = {}
        for r in N.nearest(df, df, 20, confidence=1.0, **settings).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == expected


def sum_in_order(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


def test_chi_square_values():
    # table values of the chi-square law, 8 degrees of freedom
    assert N.chi_square(np.array([2.733, 7.344, 15.507]), 8) == pytest.approx([0.05, 0.5, 0.95], abs=1e-3)
    assert N.chi_square(np.array([0.0, np.inf, 1e9]), 8).tolist() == [0, 1, 1]


def test_leaves_hold_every_row_once():
    points = np.random.default_rng(0).standard_normal((1000, 4))
    points[:400] = 1.0
    leaves = N.kd_leaves(points, 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 16
