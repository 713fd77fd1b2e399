"""Train/test splits and seed sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.hashing import hash_number, hash_share, hash_text, key_text
from tallywright.functions.naming import spare_name
from tallywright.operators.numbering import with_any_place
from tallywright.operators.selection import order_statistics

#: Default of the largest sample.
MAX_SAMPLE = 100_000


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Bernoulli split. The same seed gives other rows once the partitioning differs."""
    return df.randomSplit(list(weights), seed)


def split_by_hash(
    df: DataFrame, key: str | Sequence[str], share: float, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row key; the same rows on any cluster, in a single filter.

    Returns the part with about ``share`` of the keys and the rest. Rows with a null key go
    together, to the first part unless the share is 0.
    """
    chosen = F.coalesce(hash_share(key, seed), F.lit(0.0)) < share
    return df.filter(chosen), df.filter(~chosen)


@dataclass
class _Cut:
    """Where the lowest ``size`` rows end: rows below that key, rows of the key itself."""

    below: Column
    at: Column
    rows_below: int
    rows_at: int


def _cut(df: DataFrame, digest: Column, text: Column, rows: int, size: int) -> _Cut:
    """The key at which the rows of lowest digest reach ``size``, out of ``rows`` rows.

    Found by exact selection on the leading 48 bits of the digest and then among the few keys that
    share them, so nothing is sorted as a whole.
    """
    leading = hash_number(digest, 12).cast("double")
    keys = df.select(leading.alias("leading"), digest.alias("digest"), text.alias("key"))
    hit = order_statistics(
        keys.select("leading"), {"leading": [size - 1]}, {"leading": rows}, uniform=(0.0, 2.0**48)
    )
    place = hit["leading", size - 1]
    tied = (
        keys.filter(F.col("leading") == place.value)
        .groupBy("digest", "key")
        .agg(F.count("*").alias("count"))
        .orderBy("digest", "key")
        .collect()  # distinct keys that share 48 bits of their hash
    )
    below = place.strictly_below
    for last in tied:
        if below + last["count"] >= size:
            break
        below += last["count"]
    same = digest == last["digest"]
    return _Cut(
        (digest < last["digest"]) | (same & (text < last["key"])), same & (text == last["key"]), below, last["count"]
    )


def split_exact(
    df: DataFrame, key: str | Sequence[str], test_share: float = 0.2, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Split off exactly ``ceil(test_share * n)`` rows, those with the lowest key hashes.

    Returns ``(train, test)``. The cut is found by selection, see :func:`_cut`. If the key at the
    cut repeats, its rows are cut again in the same way, by the hash of their whole content. Rows
    that are equal altogether are told apart by a stored number only. A key, or a row, that a third
    of the table repeats is therefore counted in every task and sorted in none.
    """
    digest, text = hash_text(key, seed), key_text(key)
    rows, keyed = df.agg(F.count(F.lit(1)), F.count(text)).first()
    if keyed < rows:
        raise ValueError("the split key must not be null")
    size = math.ceil(test_share * rows)
    if size <= 0 or size >= rows:
        everything, nothing = df, df.limit(0)
        return (everything, nothing) if size <= 0 else (nothing, everything)
    cut = _cut(df, digest, text, rows, size)
    if cut.rows_below + cut.rows_at == size:
        in_test = cut.below | cut.at
        return df.filter(~in_test), df.filter(in_test)
    more = size - cut.rows_below
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    inner = _cut(df.filter(cut.at), F.md5(content), content, cut.rows_at, more)
    in_test, equal = cut.below | (cut.at & inner.below), cut.at & inner.at
    rest = more - inner.rows_below
    if rest == inner.rows_at:
        in_test = in_test | equal
        return df.filter(~in_test), df.filter(in_test)
    place = spare_name(df, "place")
    numbered = with_any_place(df.filter(equal), place)
    test = numbered.filter(F.col(place) < rest).drop(place)
    train = numbered.filter(F.col(place) >= rest).drop(place)
    return df.filter(~in_test & ~equal).unionByName(train), df.filter(in_test).unionByName(test)


def sample_seeds(
    df: DataFrame, key: str | Sequence[str], k: int, seed: str = "0", most: int = MAX_SAMPLE
) -> DataFrame:
    """k rows without replacement, in hash order; each task keeps only its best k.

    ``most`` guards the one task that ranks the best rows of all tasks; raise it if that has room.
    """
    if not 0 < k <= most:
        raise ValueError(f"k must be between 1 and {most}")
    return df.orderBy(hash_text(key, seed), key_text(key)).limit(k)
