"""Hash expressions that give the same value on every cluster, partitioning and engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(keys: str | Sequence[str]) -> Column:
    """The row key as one string, null if a single key is.

    Of several columns each value carries its length, and a null is ``-``, so that different keys
    give different texts.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if len(names) == 1:
        return F.col(f"`{names[0]}`").cast("string")
    texts = [F.col(f"`{name}`").cast("string") for name in names]
    sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.concat_ws("|", *sized)


def hash_text(keys: str | Sequence[str], seed: str = "") -> Column:
    """Hex digest of the key, optionally salted with a seed."""
    text = key_text(keys)
    return F.md5(F.concat(text, F.lit(seed)) if seed else text)


def hash_number(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a number, keeping their order."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def hash_share(keys: str | Sequence[str], seed: str = "") -> Column:
    """The key hashed to a number in [0, 1)."""
    return hash_number(hash_text(keys, seed), 8) / F.lit(float(2**32))
