"""Column expressions that keep nested functions linear: bound values, running totals, settled columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it.

    An expression inside a lambda function is evaluated again at each of its places; a lambda
    function's own variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array, one for each element, its own value included.

    A fold that appends to an array copies it at every step. So the array is cut into pieces of
    the square root of its length; the totals of whole pieces come first, then each piece starts
    from the total before it, and n elements cost some n ** 1.5 copies instead of n ** 2.
    """

    def totals(part: Column, first: Column) -> Column:
        """The first value and the running ones after it."""
        return F.aggregate(
            part, F.array(first), lambda done, x: F.concat(done, F.array(combine(F.element_at(done, -1), x)))
        )

    def of_pieces(pieces: Column) -> Column:
        sums = F.transform(pieces, lambda piece: F.aggregate(piece, zero, combine))
        return let(
            totals(sums, zero),
            lambda starts: F.flatten(
                F.transform(pieces, lambda piece, k: F.slice(totals(piece, F.get(starts, k)), F.lit(2), F.size(piece)))
            ),
        )

    def cut(whole: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(whole))).cast("int")
        return F.transform(
            F.sequence(F.lit(1), F.size(whole), width), lambda first: F.slice(whole, first, width)
        )

    return let(values, lambda whole: F.when(F.size(whole) == 0, whole).otherwise(let(cut(whole), of_pieces)))


def settled(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that a later filter reads as values and does not take apart.

    A filter over a projection is rewritten in terms of what the projection computes, once for each
    mention, and nested mentions multiply. Over a generator it is not: each row makes one row here.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {name.lower() for name in columns}]
    return df.select(*kept, F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
