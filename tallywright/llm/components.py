"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.session import materialize


def connected(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b); one root per component.

    Each round hooks every root that has a smaller neighbour onto the smallest, shortens the
    chains this makes, and keeps the edges whose ends still differ. At least every second root of
    a live edge goes, in expectation, so the rounds follow the logarithm of the longest chain. A
    round's tables are written to the shared folder, so the lineage stays short and lost executors
    cost one round; minima are taken before rows are shuffled, so a node with very many edges costs
    each task one row.
    """
    pairs = edges.select(F.col("a").alias("lo"), F.col("b").alias("hi"))
    live = _ordered(pairs)
    labels = None
    while True:
        live = materialize(live, "live-edges")
        if labels is None:
            nodes = live.select(F.col("lo").alias("node")).union(live.select("hi")).distinct()
            labels = materialize(nodes.withColumn("root", F.col("node")), "labels")
        if live.isEmpty():
            return labels
        hooks = live.groupBy(F.col("hi").alias("child")).agg(F.min("lo").alias("parent"))
        for _ in range(jumps):
            upper = hooks.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            hooks = hooks.join(upper, "parent", "left").select(
                "child", F.coalesce("above", "parent").alias("parent")
            )
        hooks = materialize(hooks, "hooks")
        labels = materialize(_follow(labels, "root", hooks), "labels")
        live = _ordered(_follow(_follow(live, "hi", hooks), "lo", hooks))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of different ends, the smaller first."""
    return (
        pairs.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
        .filter("lo < hi")
        .distinct()
    )


def _follow(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """Replace a column of roots by their parents where they have one."""
    joined = df.join(hooks.withColumnRenamed("child", column), column, "left")
    return joined.select(
        *[F.coalesce("parent", c).alias(c) if c == column else F.col(c) for c in df.columns]
    )
