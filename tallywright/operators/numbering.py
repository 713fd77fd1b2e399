"""Places of rows in a total order, for any number of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.naming import spare_name
from tallywright.session import materialize

#: Rows that one task orders.
TASK_ROWS = 200_000
#: ``monotonically_increasing_id`` holds the place within a task in so many low bits.
PLACE_BITS = 33


def with_place(df: DataFrame, order: Sequence[str | Column], out: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add the place of every row in the given order, from 0; the rows come back in that order.

    Ranges of the order go to tasks, which sort their own; a task's first place is the sum of the
    sizes before it, and only these sizes pass through the driver. Rows that are equal in the order
    share a task and get places in any order, so the order should tell rows apart. Numbers are
    written down once, with the rows, and stay the same however often the result is read.
    """
    rows = materialize(df, "unplaced")  # range bounds come from a sample of the same rows
    tasks = max(1, math.ceil(rows.count() / task_rows))
    ranged = rows.repartitionByRange(tasks, *order) if tasks > 1 else rows.coalesce(1)
    return with_any_place(ranged.sortWithinPartitions(*order), out)


def with_any_place(df: DataFrame, out: str) -> DataFrame:
    """Add a number from 0 to every row: the order of tasks, and in a task of its rows.

    The rows are stored with their numbers, and only the number of rows of each task passes through
    the driver.
    """
    within, task = spare_name(df, "within"), spare_name(df, "task")
    stored = materialize(df.withColumn(within, F.monotonically_increasing_id()), "in-order")
    number = F.shiftright(F.col(within), PLACE_BITS).cast("int")
    sizes = stored.groupBy(number.alias(task)).agg(F.count(F.lit(1)).alias("rows")).orderBy(task).collect()
    firsts, before = [], 0
    for size in sizes:
        firsts.append((size[task], before))
        before += size["rows"]
    # one row for each task
    table = df.sparkSession.createDataFrame(firsts, f"{task} int, `{out}` bigint")
    place = F.col(within).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    joined = stored.withColumn(task, number).join(F.broadcast(table), task)
    return joined.withColumn(out, F.col(out) + place).select(*[F.col(f"`{c}`") for c in df.columns], out)
