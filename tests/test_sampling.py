import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from tallywright.operators import sampling, selection
from tallywright.operators.numbering import with_any_place, with_place


def digest(value):
    return hashlib.md5(str(value).encode()).hexdigest()


@pytest.mark.parametrize("rows, share", [(1000, 0.2), (997, 0.2), (10, 0.33), (5, 0.0), (5, 1.0)])
@pytest.mark.parametrize("block", [5, 10_000])
def test_exact_split_takes_the_lowest_hashes(spark, monkeypatch, rows, share, block):
    monkeypatch.setattr(selection, "BLOCK", block)
    train, test = sampling.split_exact(spark.range(rows), "id", share)
    expected = sorted(range(rows), key=digest)[: math.ceil(share * rows)]
    assert {r.id for r in test.collect()} == set(expected)
    assert train.count() == rows - len(expected)


def test_exact_split_of_repeated_keys(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    for share in (0.1, 0.5, 0.9):
        train, test = sampling.split_exact(df, "k", share)
        assert test.count() == 200 * share
        assert train.unionByName(test).distinct().count() == 200


@pytest.mark.parametrize("block", [5, 10_000])
def test_exact_split_inside_a_hot_key(spark, monkeypatch, block):
    monkeypatch.setattr(selection, "BLOCK", block)
    rows = [("hot" if k % 3 else f"k{k}", k % 40, "x") for k in range(900)]
    df = spark.createDataFrame(rows, "`k.ey` string, n int, s string").repartition(4)

    def place(row):
        content = json.dumps(dict(zip(("k.ey", "n", "s"), row, strict=True)), separators=(",", ":"))
        return digest(row[0]), row[0], digest(content)

    for share in (0.05, 0.3, 0.5, 0.9):
        train, test = sampling.split_exact(df, "k.ey", share)
        size = math.ceil(share * len(rows))
        expected = sorted(rows, key=place)[:size]
        assert sorted(map(tuple, test.collect())) == sorted(expected)
        assert sorted(map(tuple, train.unionByName(test).collect())) == sorted(rows)
        plans = [part._jdf.queryExecution().executedPlan().toString() for part in (train, test)]
        assert not any("Window" in plan or "Sort [" in plan for plan in plans)


def test_places_follow_the_order_over_many_tasks(spark):
    rows = [(k * 7919 % 1000, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "a int, id int").repartition(7)
    placed = with_place(df, [F.desc("a"), "id"], "place", task_rows=90)
    expected = {r[1]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert {r.id: r.place for r in placed.collect()} == expected and placed.count() == 1000
    assert with_place(df.limit(0), ["a"], "place").count() == 0
    assert sorted(r.place for r in with_any_place(df, "place").collect()) == list(range(1000))


def test_null_and_composite_keys_are_kept_apart(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None), ("a|b", "c"), ("a", "b|c")], "x string, y string")
    digests = df.select(sampling.hash_text(["x", "y"]).alias("d")).distinct()
    assert digests.count() == 4 and digests.filter("d is null").count() == 0
    rows = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), "id")
    one, two = sampling.split_by_hash(rows, "k", 0.5)
    assert one.count() + two.count() == 100 and two.filter("k is null").count() == 0


def test_exact_split_refuses_null_keys(spark):
    with pytest.raises(ValueError):
        sampling.split_exact(spark.range(10).select(F.lit(None).cast("int").alias("k")), "k", 0.5)


def test_hash_split_does_not_depend_on_partitioning(spark):
    one, _ = sampling.split_by_hash(spark.range(5000).coalesce(1), "id", 0.7)
    many, rest = sampling.split_by_hash(spark.range(5000).repartition(13), "id", 0.7)
    chosen = {r.id for r in one.collect()}
    assert chosen == {r.id for r in many.collect()}
    assert 3300 < len(chosen) < 3700
    assert rest.count() == 5000 - len(chosen)


def test_random_split_is_complete(spark):
    parts = sampling.split_random(spark.range(1000), [0.8, 0.2], 42)
    assert sum(part.count() for part in parts) == 1000


def test_seed_sample_is_repeatable_and_without_replacement(spark):
    df = spark.range(300)
    first = [r.id for r in sampling.sample_seeds(df, "id", 8, "1").collect()]
    again = [r.id for r in sampling.sample_seeds(df.repartition(9), "id", 8, "1").collect()]
    other = [r.id for r in sampling.sample_seeds(df, "id", 8, "2").collect()]
    assert first == again != other
    assert len(set(first)) == 8
