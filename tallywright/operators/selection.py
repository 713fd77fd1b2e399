"""Exact order statistics without a global sort and without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
#: Share by which edges keep off the rank.
MARGIN = 1.5 / ACCURACY
#: Values that the driver takes for one rank.
BLOCK = 10_000


@dataclass
class Bracket:
    """An open interval that is known to hold the wanted rank."""

    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None
    strictly_below: int = 0

    @property
    def share(self) -> float:
        """The wanted rank as a share of the rows inside."""
        return (self.rank - self.below + 0.5) / self.inside

    @property
    def span(self) -> tuple:
        return self.column, self.low, self.high

    def rows(self) -> Column:
        x = F.col(f"`{self.column}`")
        test = x.isNotNull() & ~F.isnan(x)
        if self.low is not None:
            test = test & (x > F.lit(self.low))
        if self.high is not None:
            test = test & (x < F.lit(self.high))
        return test

    def settle(self, value: float, strictly_below: int) -> None:
        self.value = value
        self.strictly_below = strictly_below

    def narrow(self, a: float, b: float, under: int, at_a: int, between: int, at_b: int) -> None:
        """Move to the part that holds the rank, from exact counts around ``a <= b``."""
        reached = self.below + under
        if self.rank < reached:
            self.high, self.inside = a, under
        elif self.rank < reached + at_a:
            self.settle(a, reached)
        elif self.rank < reached + at_a + between:
            self.low, self.high = a, b
            self.below, self.inside = reached + at_a, between
        elif self.rank < reached + at_a + between + at_b:
            self.settle(b, reached + at_a + between)
        else:
            passed = under + at_a + between + at_b
            self.low, self.below, self.inside = b, self.below + passed, self.inside - passed


#: Two edges around each rank, and at most how many values lie between them (None: not known).
Edges = list[tuple[float, float, float | None]]
Guess = Callable[[DataFrame, list[Bracket]], Edges]


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    sizes: Mapping[str, int],
    uniform: tuple[float, float] | None = None,
    sketches: Mapping[str, Mapping[int, tuple[float, float]]] | None = None,
) -> dict[tuple[str, int], Bracket]:
    """Values at zero-based ranks of double columns, nulls and NaN aside.

    ``sizes`` is the number of values per column. Each round guesses two edges just around the
    rank, counts exactly on both sides of them and keeps the part that holds the rank. The guess
    only decides the speed: a wrong one still leaves a smaller bracket, and a value that fills a
    bracket (a hot key) is split off at once. Edges come from approximate percentiles, about
    2000-fold closer per round, or, for values known to be ``uniform`` over a range, from their
    rank alone. ``sketches`` has the first edges of each column and rank where an earlier pass
    took :func:`sketch` along.

    Where the sketch's error bound says that no more than ``BLOCK`` values lie between the edges,
    the pass that counts brings them along and the rank is settled: with ``sketches`` one pass is
    all it takes for up to 20 million values, and one round more for each 2000-fold.
    """
    found = {
        (name, rank): Bracket(name, rank, sizes[name])
        for name, wanted in ranks.items()
        for rank in wanted
    }
    for bracket in found.values():
        if not 0 <= bracket.rank < bracket.inside:
            raise ValueError(f"rank {bracket.rank} is outside column {bracket.column}")
    trials = 0
    while wide := [b for b in found.values() if b.value is None and b.inside > BLOCK]:
        # Values that prove to be less even than promised are left to the percentiles.
        trials += 1
        if sketches and trials == 1:
            guess = _sketched_edges(sketches)
        else:
            guess = _uniform_edges(*uniform) if uniform and trials <= 3 else _percentile_edges
        _narrow(df, wide, guess(df, wide))
    if last := [b for b in found.values() if b.value is None]:
        _settle(df, last)
    return found


def sketch(column: Column, shares: Sequence[float]) -> Column:
    """An aggregate with two approximate percentiles for each share, just below and above it."""
    around = [min(1.0, max(0.0, share + side * MARGIN)) for share in shares for side in (-1, 1)]
    return F.percentile_approx(column, around, ACCURACY)


def _between(inside: int) -> float:
    """Most values between two sketched edges: both margins, and the error of both percentiles."""
    return inside * 2 * (MARGIN + 1 / ACCURACY)


def _sketched_edges(sketches: Mapping[str, Mapping[int, tuple[float, float]]]) -> Guess:
    return lambda _, brackets: [(*sketches[b.column][b.rank], _between(b.inside)) for b in brackets]


def _percentile_edges(df: DataFrame, brackets: list[Bracket]) -> Edges:
    """Approximate percentiles around each rank; brackets with one span share an aggregate."""
    wanted: dict[tuple, list[float]] = {}
    places = []
    for bracket in brackets:
        shares = wanted.setdefault(bracket.span, [])
        places.append((bracket.span, len(shares)))
        shares += [max(0.0, bracket.share - MARGIN), min(1.0, bracket.share + MARGIN)]
    spans = {span: f"g{i}" for i, span in enumerate(wanted)}
    inside = {bracket.span: bracket.rows() for bracket in brackets}
    guesses = [
        F.percentile_approx(F.when(inside[span], F.col(f"`{span[0]}`")), shares, ACCURACY).alias(spans[span])
        for span, shares in wanted.items()
    ]
    row = df.agg(*guesses).first()
    return [
        (row[spans[span]][at], row[spans[span]][at + 1], _between(bracket.inside))
        for (span, at), bracket in zip(places, brackets)
    ]


def _uniform_edges(start: float, stop: float) -> Guess:
    """Six standard deviations around the place of the rank in evenly spread values."""

    def edges(_: DataFrame, brackets: list[Bracket]) -> Edges:
        found = []
        for bracket in brackets:
            low = start if bracket.low is None else bracket.low
            width = (stop if bracket.high is None else bracket.high) - low
            share = bracket.share
            margin = 6 * math.sqrt(share * (1 - share) / bracket.inside) + 6 / bracket.inside
            found.append(
                (low + width * max(0.0, share - margin), low + width * min(1.0, share + margin), None)
            )
        return found

    return edges


def _narrow(df: DataFrame, brackets: list[Bracket], edges: Edges) -> None:
    """Count each column's values below and at every edge, then move or settle the brackets.

    A value falls into one cell between or on the sorted edges of its column, so a round is one
    grouped count with a few cells per column, combined on the map side. Cells that hold few values
    are counted value by value.
    """
    marks: dict[str, list[float]] = {}
    for bracket, (a, b, _) in zip(brackets, edges):
        marks[bracket.column] = sorted({*marks.get(bracket.column, []), a, b})
    columns = list(marks)
    opened: dict[int, set[int]] = {i: set() for i in range(len(columns))}
    for bracket, (a, b, most) in zip(brackets, edges):
        if most is not None and most <= BLOCK:
            own = marks[bracket.column]
            opened[columns.index(bracket.column)].update(range(2 * own.index(a) + 2, 2 * own.index(b) + 1, 2))
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("place"), _cell(F.col(f"`{name}`"), marks[name]).alias("cell"), F.col(f"`{name}`").alias("x")
            )
            for i, name in enumerate(columns)
        ]
    )
    is_open = F.lit(False)
    for i, numbers in opened.items():
        if numbers:
            is_open = is_open | ((F.col("place") == i) & F.col("cell").isin(sorted(numbers)))
    counted = (
        df.select(F.inline(cells))
        .filter(F.col("cell").isNotNull())
        .groupBy("place", "cell", F.when(is_open, F.col("x")).alias("value"))
        .agg(F.count("*").alias("count"))
        .collect()
    )
    counts: dict[tuple[str, int], int] = {}
    values: dict[tuple[str, int], list[tuple[float, int]]] = {}
    for row in counted:
        cell = columns[row.place], row.cell
        counts[cell] = counts.get(cell, 0) + row["count"]
        if row.value is not None:
            values.setdefault(cell, []).append((row.value, row["count"]))
    below = {}
    for name, own in marks.items():
        total = 0
        for i, value in enumerate(own):
            total += counts.get((name, 2 * i), 0)
            below[name, value] = (total, total + counts.get((name, 2 * i + 1), 0))
            total = below[name, value][1]
    for bracket, (a, b, most) in zip(brackets, edges):
        # Rows of the bracket below an edge, and up to it.
        (under, upto_a), (under_b, upto_b) = (
            [min(max(n - bracket.below, 0), bracket.inside) for n in below[bracket.column, edge]]
            for edge in (a, b)
        )
        between = max(under_b, upto_a) - upto_a
        bracket.narrow(a, b, under, upto_a - under, between, upto_b - upto_a - between)
        if bracket.value is None and (bracket.low, bracket.high) == (a, b) and most is not None and most <= BLOCK:
            own = marks[bracket.column]
            inner: list[tuple[float, int]] = []
            for i in range(2 * own.index(a) + 2, 2 * own.index(b) + 1):
                place = bracket.column, i
                inner += values.get(place, []) if i % 2 == 0 else [(own[i // 2], counts.get(place, 0))]
            passed = bracket.below
            for value, count in sorted(inner):
                if bracket.rank < passed + count:
                    bracket.settle(value, passed)
                    break
                passed += count


def _cell(x: Column, marks: list[float]) -> Column:
    """``2 i`` below mark i, ``2 i + 1`` on it, one more past the last; null for NaN."""
    cell = F.when(x.isNull() | F.isnan(x), F.lit(None))
    for i, mark in enumerate(marks):
        cell = cell.when(x < mark, 2 * i).when(x == mark, 2 * i + 1)
    return cell.otherwise(2 * len(marks))


def _settle(df: DataFrame, brackets: list[Bracket]) -> None:
    """Gather what is left of each span, at most ``BLOCK`` values, and pick by position."""
    spans = {span: f"v{i}" for i, span in enumerate(dict.fromkeys(b.span for b in brackets))}
    inside = {bracket.span: bracket.rows() for bracket in brackets}
    values = df.agg(
        *[
            F.array_sort(F.collect_list(F.when(inside[span], F.col(f"`{span[0]}`")))).alias(name)
            for span, name in spans.items()
        ]
    )
    picks = []
    for bracket in brackets:
        name = spans[bracket.span]
        value = F.get(name, F.lit(bracket.rank - bracket.below))
        picks.append(
            F.struct(value.alias("value"), (F.array_position(name, value) - 1).alias("at"))
        )
    for bracket, pick in zip(brackets, values.select(*picks).first()):
        bracket.settle(pick.value, bracket.below + pick.at)
