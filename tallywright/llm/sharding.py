"""Placement of keys on shards by a permutation-filled lookup table.

The table has a prime number of slots. Every shard has a preference order over all slots, given by
an offset and a step drawn from its name. Shards take turns; each claims the first slot of its
order that is still free, until none is. So slots per shard differ by one at most, and adding or
removing a shard moves little more than that shard's slots. A key's slot is its hash modulo the
table size; the table is broadcast, so placing a row is one lookup and no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.text_units import spare_name

#: Default number of slots, a prime over a hundred times the usual number of shards.
TABLE_SIZE = 65_537
#: Largest table that is broadcast: 8 bytes a slot, so 32 MB.
MOST_SLOTS = 4_000_037


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE, most_slots: int = MOST_SLOTS) -> list[int]:
    """The index of the owning shard for each slot.

    Shards take turns in name order, so the table does not depend on the order in which they are
    listed. Raises ValueError for no shards, repeated names, more shards than slots, a size that is
    not prime, or one over ``most_slots``, the bound of the table that is broadcast.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, and one at least")
    if not _is_prime(size) or not len(shards) <= size <= most_slots:
        raise ValueError(f"the table size must be a prime from {len(shards)} to {most_slots}")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: _number(f"offset {shards[i]}") % size for i in turns}
    step = {i: _number(f"step {shards[i]}") % (size - 1) + 1 if size > 2 else 1 for i in turns}
    owner, free = [-1] * size, size
    while True:
        for i in turns:
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """The table as rows (slot int, shard string)."""
    owner = fill_table(shards, size)
    return spark.createDataFrame(
        pa.table({"slot": pa.array(range(size), pa.int32()), "shard": [shards[i] for i in owner]})
    )


def slot_of(keys: Sequence[Column], size: int = TABLE_SIZE) -> Column:
    """A row's slot. Every key is hashed as text; a null key is a value of its own."""
    return F.pmod(F.xxhash64(*[key.cast("string") for key in keys]), F.lit(size)).cast("int")


def place(
    df: DataFrame, keys: Sequence[str], shards: Sequence[str], size: int = TABLE_SIZE
) -> DataFrame:
    """Add the columns slot (int) and shard (string); columns of these names are replaced.

    Rows with equal keys share a shard, repeated rows and rows with null keys included: name a
    column that tells rows apart (an id) among the keys if one value may hold much of the table.
    """
    slot = spare_name(df, "slot")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {"slot", "shard"}]
    table = F.broadcast(table_frame(df.sparkSession, shards, size).withColumnRenamed("slot", slot))
    hashed = df.select(*kept, slot_of([df[f"`{key}`"] for key in keys], size).alias(slot))
    return hashed.join(table, slot).select(*kept, F.col(slot).alias("slot"), "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a placed table as Parquet, one folder per shard.

    Rows are dealt by slot: a shard has many slots, so it is written by many tasks, and a task
    writes no more than one file for each shard. Equal keys, which share a slot, share a file.
    """
    placed.repartition("slot").write.partitionBy("shard").parquet(path)
