"""Joins with a table of any size whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.naming import spare_name

#: Keys that may be broadcast. A key counts as hot if it has more than this share of all rows, so
#: that fewer keys than this are hot, whatever the data.
HOT_KEYS = 1_000


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    values: Sequence[str],
    weight: str,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Add the values of each row's key, null for a null or unknown key.

    ``table`` has one row for each key, and in ``weight`` how many rows carry it. Rows of hot keys
    meet a broadcast of these keys and are not shuffled; all others are joined by shuffle, where no
    key has more than a ``hot_keys``-th of the rows. A table of no more than ``hot_keys`` keys is
    broadcast whole and ``rows`` is read once, otherwise twice.
    """
    known = table.agg(F.count(F.lit(1)).alias("keys"), F.sum(weight).alias("rows")).first()
    own, added = [F.col(f"`{c}`") for c in rows.columns], [F.col(f"`{c}`") for c in values]
    if known["keys"] <= hot_keys:
        return rows.join(F.broadcast(table.select(key, *added)), key, "left").select(*own, *added)
    is_hot = F.col(weight) * hot_keys > F.lit(known["rows"])
    mark = spare_name(rows, "hot")
    hot = table.filter(is_hot).select(key, *added, F.lit(True).alias(mark))
    cold = table.filter(~is_hot).select(key, *added)
    met = rows.join(F.broadcast(hot), key, "left")
    near = met.filter(F.col(mark) | F.col(key).isNull()).select(*own, *added)
    far = met.filter(F.col(mark).isNull() & F.col(key).isNotNull()).select(*own)
    return near.unionByName(far.join(cold, key, "left").select(*own, *added))
