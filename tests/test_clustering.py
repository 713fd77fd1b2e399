import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywright.operators import clustering as C
from tallywright.operators import many_centroids
from tallywright.sources import read_points


def lloyd(points, centres, steps):
    ids = list(range(len(centres)))
    for _ in range(steps):
        distance = np.array([((points - c) ** 2).sum(axis=1) for c in centres])
        nearest = distance.argmin(axis=0)
        kept = [i for i in range(len(centres)) if (nearest == i).any()]
        centres = [points[nearest == i].mean(axis=0) for i in kept]
        ids = [ids[i] for i in kept]
    return dict(zip(ids, centres))


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    values = np.concatenate([rng.normal(m, 2, (200, 2)) for m in (0, 10, 30)])
    df = spark.createDataFrame([(float(a), float(b), [float(a), float(b)]) for a, b in values],
                               "px double, py double, x array<double>").repartition(5).persist()
    return values, df


def test_ties_go_to_the_lowest_id(spark):
    df = spark.createDataFrame([([0.5, 0.5],)], "x array<double>")
    seeds = [(0, [0.0, 0.0]), (1, [1.0, 1.0])]
    assert C.assign_nearest(df, seeds).first().cid == 0
    assert C.assign_nearest(df, [(4, [1.0, 1.0]), (2, [0.0, 0.0])]).first().cid == 2


@pytest.mark.parametrize("features", ["x", ["px", "py"]])
@pytest.mark.parametrize("limit", [0, 128])
def test_both_kernels_equal_brute_force(cloud, monkeypatch, features, limit):
    values, df = cloud
    monkeypatch.setattr(C, "UNROLL_LIMIT", limit)
    seeds = [(i, list(map(float, values[i * 150]))) for i in range(4)]
    rows = C.assign_nearest(df, seeds, features).collect()
    for row in rows:
        distance = [(row.px - a) ** 2 + (row.py - b) ** 2 for _, (a, b) in seeds]
        assert row.cid == int(np.argmin(distance))


def test_kernels_agree_on_ties_and_malformed_points(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0], [1.0, 2.0, 3.0], [nan, 1.0], [1.0, None], [inf, 0.0], [4.0, 4.0]]
    grid = [[round(0.1 * i, 1), round(0.1 * j, 1)] for i in range(40) for j in range(40)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(odd + grid)], "id int, x array<double>")
    seeds = [(0, [0.3, 0.7]), (1, [0.7, 0.3]), (2, [2.1, 2.2])]
    answers = []
    for limit in (0, 10**9):
        monkeypatch.setattr(C, "UNROLL_LIMIT", limit)
        answers.append({r.id: r.cid for r in C.assign_nearest(df, seeds).collect()})
    assert answers[0] == answers[1]
    assert [answers[0][k] for k in range(len(odd))] == [None] * 7 + [2]


def test_fit_reports_bad_points(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0],), (None,), ([2.0, 2.0],)], "x array<double>")
    result = C.kmeans_fit(df, [(0, [0.0, 0.0])], 2)
    assert result.bad_count() == 2 and result.centroids == [(0, [1.0, 1.0])]


def test_mean_of_a_cluster(cloud):
    values, df = cloud
    got = {r.cid: (r.c, r.size) for r in C.recompute_centroids(
        df.withColumn("cid", F.lit(1)), "x", 2).collect()}
    assert np.allclose(got[1][0], values.mean(axis=0))
    assert got[1][1] == len(values)


@pytest.mark.parametrize("features", ["x", ["px", "py"]])
def test_fit_equals_brute_force(cloud, features):
    values, df = cloud
    seeds = [(i, list(map(float, values[i]))) for i in range(3)] + [(3, [1e6, 1e6])]
    result = C.kmeans_fit(df, seeds, 15, features)
    expected = lloyd(values, [np.array(c) for _, c in seeds], 15)
    assert [cid for cid, _ in result.centroids] == sorted(expected)
    for cid, centre in result.centroids:
        assert np.allclose(centre, expected[cid])
    assert result.history().select("iteration").distinct().count() == 15
    assert result.timings().count() == 15


def test_distortion_never_rises(cloud):
    values, df = cloud
    seeds = [(i, list(map(float, values[i]))) for i in range(3)]
    steps = {}
    for iteration, cid, centre, _, _ in C.kmeans_fit(df, seeds, 6).steps:
        steps.setdefault(iteration, []).append(centre)
    costs = [
        np.min([((values - np.array(c)) ** 2).sum(axis=1) for c in centres], axis=0).sum()
        for _, centres in sorted(steps.items())
    ]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_empty_cluster_can_be_kept_and_ids_stay(spark):
    df = spark.createDataFrame([([0.0],), ([1.0],), ([10.0],)], "x array<double>")
    seeds = [(0, [0.0]), (1, [500.0]), (2, [9.0])]
    assert C.kmeans_fit(df, seeds, 2).centroids == [(0, [0.5]), (2, [10.0])]
    assert C.kmeans_fit(df, seeds, 2, empty="keep").centroids == [
        (0, [0.5]),
        (1, [500.0]),
        (2, [10.0]),
    ]
    with pytest.raises(ValueError):
        C.kmeans_fit(df, seeds, 2, empty="other")


def test_tolerance_stops_early(spark):
    df = spark.createDataFrame([([0.0],), ([1.0],)], "x array<double>")
    assert len(C.kmeans_fit(df, [(0, [3.0])], 15, tol=1e-6).milliseconds) == 2


def test_bad_points_are_set_apart(strings, spark):
    points = read_points(strings("1,2", "1,2,3", "NaN,1", "1,x", "1", "", "Infinity,2", "3,4"))
    good, bad = C.split_valid_points(points, "x", 2)
    assert [r.x for r in good.collect()] == [[1.0, 2.0], [3.0, 4.0]]
    assert bad.count() == 6
    columns = spark.createDataFrame([(1.0, None), (1.0, 2.0), (float("nan"), 1.0)], "a double, b double")
    good, bad = C.split_valid_points(columns, ["a", "b"], 2)
    assert (good.count(), bad.count()) == (1, 2)
    assert C.kmeans_fit(points, [(0, [0.0, 0.0])], 1).centroids == [(0, [2.0, 3.0])]


def test_centroids_of_different_width_are_refused(spark):
    df = spark.createDataFrame([([0.0],)], "x array<double>")
    with pytest.raises(ValueError):
        C.assign_nearest(df, [(0, [1.0]), (1, [1.0, 2.0])])


def test_fit_without_cache(cloud):
    values, df = cloud
    seeds = [(i, list(map(float, values[i]))) for i in range(3)]
    cached, plain = C.kmeans_fit(df, seeds, 3), C.kmeans_fit(df, seeds, 3, storage=None)
    assert np.allclose([c for _, c in cached.centroids], [c for _, c in plain.centroids])


def test_sizes(cloud):
    values, df = cloud
    sizes = C.cluster_sizes(C.assign_nearest(df, [(0, [0.0, 0.0]), (1, [30.0, 30.0])]))
    assert sum(r.size for r in sizes.collect()) == len(values)


@pytest.mark.parametrize("task_points", [40, 50_000])
def test_many_centroids_equal_a_comparison_with_all(spark, monkeypatch, task_points):
    monkeypatch.setattr(many_centroids, "TASK_POINTS", task_points)
    rng = np.random.default_rng(4)
    centres = np.round(rng.normal(0, 10, (700, 3)), 1)
    centres[100:160] = centres[5]  # equal ones: the lowest id wins
    points = np.concatenate([np.round(rng.normal(0, 10, (500, 3)), 1), np.repeat(centres[[5, 300]], 90, axis=0), [[1e6, -1e6, 3]]])
    ids = rng.permutation(700) * 3
    table = spark.createDataFrame([(int(i), [float(v) for v in c]) for i, c in zip(ids, centres, strict=True)], "cid int, c array<double>")
    rows = [(k, [float(v) for v in p], "x") for k, p in enumerate(points)]
    rows += [(9000, None, "x"), (9001, [1.0], "x"), (9002, [1.0, float("nan"), 2.0], "x")]
    df = spark.createDataFrame(rows, "id int, x array<double>, cid string").repartition(5)
    expected = {9000: None, 9001: None, 9002: None}
    for k, p in enumerate(points):
        total = np.zeros(700)
        for j in range(3):
            total += (p[j] - centres[:, j]) ** 2
        expected[k] = int(min(zip(total.tolist(), ids.tolist(), strict=True))[1])
    got = C.assign_nearest(df, table, most_literal=600)
    assert got.columns == ["id", "x", "cid"] and {r.id: r.cid for r in got.collect()} == expected
    few = {r.id: r.cid for r in C.assign_nearest(df.drop("cid"), table, most_literal=700).collect()}
    assert few == expected
    with pytest.raises(ValueError):
        C.assign_nearest(df, table.union(table), most_literal=10)


def test_most_groups_are_left_out(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (2000, 2)) + 100 * rng.integers(0, 40, (2000, 1))
    pivots = centres[:45]
    near = many_centroids.square_distances(centres, pivots).argmin(axis=1)
    radius = np.array([np.sqrt(((centres[near == g] - pivots[g]) ** 2).sum(axis=1)).max() for g in range(45)])
    df = spark.createDataFrame([(k, [float(v) for v in centres[k]]) for k in range(2000)], "row long, x array<double>")
    assert many_centroids._candidates(df, pivots, radius).count() < 2000 * 15


@pytest.mark.parametrize("values", [9, 120, 1 << 20])
def test_a_task_meets_bounded_parts_and_slices(spark, monkeypatch, values):
    """However many groups may hold a point's nearest, and however large one is; half of all centroids are one place."""
    monkeypatch.setattr(many_centroids, "TASK_VALUES", values)
    rng = np.random.default_rng(6)
    centres = np.round(rng.normal(0, 1, (60, 3)), 2)
    centres[30:] = centres[2]
    points = np.round(rng.normal(0, 1, (50, 3)), 2)
    table = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cid int, c array<double>")
    df = spark.createDataFrame([(k, [float(v) for v in p]) for k, p in enumerate(points)], "id int, x array<double>")
    expected = {k: int(((p - centres) ** 2).sum(axis=1).argmin()) for k, p in enumerate(points)}
    assert {r.id: r.cid for r in C.assign_nearest(df, table, most_literal=10).collect()} == expected


def test_batches_of_candidates_are_bounded(monkeypatch):
    """Every group may hold the nearest of every point; no batch holds more than ``TASK_VALUES`` of their numbers."""
    monkeypatch.setattr(many_centroids, "TASK_VALUES", 60)

    class Points:
        def mapInArrow(self, kernel, schema):
            rows = pa.array(range(40), pa.int64())
            x = pa.array([[float(k), 1.0, 2.0] for k in range(40)], pa.list_(pa.float64()))
            return list(kernel(iter([pa.record_batch([rows, x], ["row", "x"])])))

    pivots = np.array([[float(k), 0.0, 0.0] for k in range(10)])
    batches = many_centroids._candidates(Points(), pivots, np.full(10, 1e3))
    assert sum(b.num_rows for b in batches) == 400 and max(b.num_rows for b in batches) == 20


@pytest.mark.parametrize("offset,scale", [(0, 1), (1e6, 1), (-3e3, 1e-30), (0, 1e30), (0, 1e-100)])
def test_products_leave_the_nearest_in(monkeypatch, offset, scale):
    """Not all pairs are compared number by number, yet the nearest is exact: far from zero, tiny, huge, equal, nearly equal."""
    rng = np.random.default_rng(8)
    c = rng.normal(0, 1, (900, 5))
    c[300:500] = c[7]
    c[500:700] = c[8] + rng.normal(0, 1e-9, (200, 5))
    x = np.concatenate([rng.normal(0, 1, (300, 5)), c[5:12], c[8] + rng.normal(0, 1e-9, (40, 5)), [[1e4] * 5]])
    x, c = (np.ascontiguousarray(side + offset) * scale for side in (x, c))
    pivots = c[[0, 7, 8, 20, 21, 22]]
    every = many_centroids.square_distances(c, pivots)
    group = every.argmin(axis=1)
    radius = np.array([np.sqrt(every[group == k, k]).max(initial=-np.inf) for k in range(6)])
    ids = rng.permutation(900)
    between = many_centroids.square_distances(x, c)
    expected = [int(min(zip(row.tolist(), ids.tolist(), strict=True))[1]) for row in between]
    monkeypatch.setattr(many_centroids, "square_distances", None)
    points = pa.table({"row": range(len(x)), "x": x.tolist()})
    centroids = pa.table({"group": group, "cid": ids, "c": c.tolist()})
    for block in (1 << 20, 3_000):  # in one step, and compared part by part
        monkeypatch.setattr(many_centroids, "BLOCK", block)
        found = many_centroids._nearest(pivots, radius)(points, centroids).to_pydict()
        assert found["row"] == list(range(len(x))) and found["cid"] == expected
        assert found["distance"] == between.min(axis=1).tolist()
