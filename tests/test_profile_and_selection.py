import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywright.operators import profile, selection


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(5)
    hot = [7.25] * 4000
    rows = hot + [rng.gauss(0, 1) * 10 ** rng.randint(-3, 6) for _ in range(5000)]
    rows += [rng.randint(0, 3) for _ in range(3000)]
    rng.shuffle(rows)
    pairs = [(float(x), float(i % 11) if i % 7 else None) for i, x in enumerate(rows)]
    return spark.createDataFrame(pairs, "x double, y double").repartition(6).persist()


@pytest.mark.parametrize("block", [10, 300, 10_000])
def test_percentiles_equal_pandas_whatever_the_block(numbers, monkeypatch, block):
    monkeypatch.setattr(selection, "BLOCK", block)
    monkeypatch.setattr(selection, "ACCURACY", 50)
    expected = numbers.toPandas().describe()
    for row in profile.describe_percentiles(numbers).collect():
        want = expected[row.column]
        got = [row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]]
        assert np.allclose(got, want.to_numpy(), rtol=1e-9)


@pytest.mark.parametrize("uniform", [None, (0.0, 2.0**48)])
def test_order_statistics_equal_sorting(numbers, monkeypatch, uniform):
    """Also with a promise of even values that does not hold."""
    monkeypatch.setattr(selection, "BLOCK", 20)
    values = sorted(r.x for r in numbers.select("x").collect())
    ranks = [0, 1, 2999, 6000, 7000, len(values) - 1]
    found = selection.order_statistics(numbers, {"x": ranks}, {"x": len(values)}, uniform)
    for rank in ranks:
        hit = found["x", rank]
        assert hit.value == values[rank]
        assert hit.strictly_below == values.index(values[rank])


def passes(monkeypatch, run):
    """How many times a result is fetched while ``run`` runs."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(1) or collect(self))
    run()
    return len(seen)


def test_exact_percentiles_take_two_passes(spark, numbers, monkeypatch):
    assert passes(monkeypatch, lambda: profile.describe_percentiles(numbers)) == 2
    large = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_017).cast("double").alias("a.b"), (F.col("id") % 5).alias("n"))
    assert passes(monkeypatch, lambda: profile.describe_percentiles(large)) == 2
    rows = {r.column: r for r in profile.describe_percentiles(large).collect()}
    values = np.arange(3_000_000, dtype=np.int64) * 7919 % 3_000_017
    assert [rows["a.b"][p] for p in ("p25", "p50", "p75")] == np.percentile(values, [25, 50, 75]).tolist()
    assert (rows["n"].p25, rows["n"].p50, rows["n"].p75) == (1.0, 2.0, 3.0)


def test_dotted_names(spark):
    df = spark.createDataFrame([(float(k), k) for k in range(11)], "`a.b` double, `c.d` int")
    assert {r.column: r.p50 for r in profile.describe_percentiles(df).collect()} == {"a.b": 5.0, "c.d": 5.0}
    assert profile.histogram(df, "a.b", 5).agg({"count": "sum"}).first()[0] == 11
    with pytest.raises(ValueError):
        profile.histogram(df, "a.b", 5, most_bins=4)


def test_percentiles_leave_nan_and_empty_columns_out(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "a double, b double")
    rows = {r.column: r for r in profile.describe_percentiles(df).collect()}
    assert (rows["a"]["count"], rows["a"].p50) == (2, 2.0)
    assert (rows["b"]["count"], rows["b"].p50) == (0, None)


def test_approximate_percentiles_are_close(numbers):
    rows = {r.column: r for r in profile.describe_percentiles(numbers, approximate=True).collect()}
    assert rows["y"].p50 == 5.0


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_numpy(spark, bins):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 30, 500) / 10, rng.normal(1, 1, 500), [2.9] * 300])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    counts, edges = np.histogram(values, bins=bins)
    rows = profile.histogram(df, "x", bins).orderBy("bin").collect()
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r.left for r in rows], edges[:-1])


def test_histogram_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    rows = profile.histogram(df, "x", 4).orderBy("bin").collect()
    assert (rows[0].left, rows[-1].right) == (4.5, 5.5)
    assert sorted(r["count"] for r in rows) == [0, 0, 0, 2]
    assert profile.histogram(df.filter("x > 9"), "x", 4).count() == 0


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, None, float("nan")), (3, "a", None)], "i int, s string, d double")
    rows = {r.column: r for r in profile.describe_table(df).collect()}
    assert (rows["i"]["count"], rows["i"].mean, rows["i"].stddev, rows["i"].max) == (3, 2.0, 1.0, 3.0)
    assert (rows["s"].min_text, rows["s"].max_text, rows["s"].mean) == ("a", "b", None)
    got = {r.column: (r.type, r.rows, r.non_null) for r in profile.profile_columns(df).collect()}
    assert got == {"i": ("int", 3, 3), "s": ("string", 3, 2), "d": ("double", 3, 1)}


def test_describe_agrees_with_the_built_in_one(numbers):
    built_in = {r.summary: r.y for r in numbers.describe("y").collect()}
    row = profile.describe_table(numbers).filter(F.col("column") == "y").first()
    assert np.isclose(row.mean, float(built_in["mean"]))
    assert np.isclose(row.stddev, float(built_in["stddev"]))
