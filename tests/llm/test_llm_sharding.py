import pytest
from llm_rows import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tallywright.llm import sharding
from tallywright.llm.queries import QUERIES, SHARDS


def brute_table(shards, size):
    """Turn-taking over written-out preference lists."""
    names = sorted(shards)
    order = {n: [(sharding._number(f"offset {n}") % size + j * (sharding._number(f"step {n}") % (size - 1) + 1)) % size
                 for j in range(size)] for n in names}
    table = {}
    while len(table) < size:
        for n in names:
            free = next((s for s in order[n] if s not in table), None)
            if free is not None:
                table[free] = n
    return [table[s] for s in range(size)]


def test_table_equals_brute_force_and_ignores_listing_order():
    shards = ["c", "a", "b", "zz", "d"]
    for size in (5, 7, 101, 251):
        got = [shards[i] for i in sharding.fill_table(shards, size)]
        assert got == brute_table(shards, size)
        other = shards[::-1]
        assert [other[i] for i in sharding.fill_table(other, size)] == got


def test_slots_are_even_and_few_move():
    before = sharding.fill_table(SHARDS)
    counts = [before.count(i) for i in range(len(SHARDS))]
    assert max(counts) - min(counts) <= 1
    after = [SHARDS[:-1][i] for i in sharding.fill_table(SHARDS[:-1])]
    moved = sum(SHARDS[b] != a for b, a in zip(before, after, strict=True)) / len(after)
    assert moved < 3 / len(SHARDS)


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 4_000_081)])
def test_bad_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, size)


def test_query_places_every_document(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_sharding"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    table = sharding.fill_table(SHARDS)
    ids = docs.select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(sharding.TABLE_SIZE)).alias("s"))
    expected = {r.doc_id: SHARDS[table[r.s]] for r in ids.collect()}
    assert {r.doc_id: r.shard for r in rows.collect()} == expected and rows.count() == docs.count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan


def test_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark).withColumn("slot", F.lit("old")).withColumn("__slot", F.lit(1))
    placed = sharding.place(docs, ["doc_id"], ["a", "b", "c"])
    assert placed.count() == docs.count() and dict(placed.dtypes)["slot"] == "int" and "__slot" in placed.columns
    assert placed.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    assert sharding.place(empty_docs(spark), ["doc_id"], ["a"]).count() == 0
    many = sharding.place(spark.range(5000), ["id"], ["a", "b"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join so few rows
    try:
        sharding.write_shards(many, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000
    assert len(list((tmp_path / "out" / "shard=a").glob("*.parquet"))) > 1  # no task writes a shard alone
    sharding.write_shards(placed, str(tmp_path / "odd"))
    assert spark.read.parquet(str(tmp_path / "odd")).count() == docs.count()
