"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). A token budget flows down the tree: at each node it is
split among the children by weight; a child that cannot use its share (its whole subtree, read
``max_epochs`` times, holds less) takes what it has, and the rest goes to its siblings by weight.
Only what all siblings together cannot use stays with the parent, and so reaches the parent's
siblings. Each leaf then reads whole epochs and, of one more, the longest prefix in seeded order
whose tokens fit its budget.

All arithmetic is on whole numbers, rounded down, so that the result does not depend on
partitioning; at each node fewer tokens are left over than it has children.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.text_units import spare_name
from tallywright.session import materialize

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order key that name a bucket; only the bucket at a leaf's cut is sorted.
BUCKET_DIGITS = 3
WIDE = "decimal(38,0)"


class Mix(NamedTuple):
    """Leaf budgets, and what reads the rows.

    ``leaves`` holds for each leaf: tokens, budget, epochs (whole ones), cut (the last order key
    taken of the next epoch, empty for none).
    """

    leaves: DataFrame
    seed: int


def path_text(level: int) -> Column:
    """A node's path as text; null is a value of its own."""
    names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in LEVELS[: level + 1]]
    return F.concat_ws("\x1f", *names)


def weight_of(level: int, weights: Mapping[tuple[str | None, ...], int]) -> Column:
    """The weight set for a path, 1 for one that is not named."""
    named = {k: v for k, v in weights.items() if len(k) == level + 1}
    if any(v < 0 or v != int(v) for v in named.values()):
        raise ValueError("weights are whole numbers from 0")
    if not named:
        return F.lit(1)
    pairs = []
    for path, weight in named.items():
        pairs += [F.lit("\x1f".join("\x00" if p is None else str(p) for p in path)), F.lit(int(weight))]
    return F.coalesce(F.element_at(F.create_map(*pairs), path_text(level)), F.lit(1))


def split_budget(children: DataFrame, parents: list[str], budget: str, out: str) -> DataFrame:
    """Fill children with columns ``weight`` and ``cap`` from the parent's budget.

    Sorted by cap per weight, those who cannot use their share come first; the rest divide what
    those leave, by weight.
    """
    group = Window.partitionBy(*parents)
    names = [c for c in LEVELS if c in children.columns]
    wide = {c: F.col(c).cast(WIDE) for c in ("weight", "cap", budget)}
    df = children.withColumns({f"{c}_wide": v for c, v in wide.items()})
    before = group.orderBy(
        F.col("cap") / F.col("weight"), *[F.col(n).asc_nulls_first() for n in names]
    ).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns(
        {
            "used": F.coalesce(F.sum("cap_wide").over(before), F.lit(0)).cast(WIDE),
            "passed": F.coalesce(F.sum("weight_wide").over(before), F.lit(0)).cast(WIDE),
            "all_weight": F.sum("weight_wide").over(group).cast(WIDE),
        }
    )
    left = (F.col(f"{budget}_wide") - F.col("used")).cast("double")
    rest = (F.col("all_weight") - F.col("passed")).cast("double")
    full = F.col("cap").cast("double") * rest <= F.col("weight").cast("double") * left
    df = df.withColumn("full", full)
    df = df.withColumns(
        {
            "taken": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)),
            "gone": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(group), F.lit(0)),
        }
    )
    share = F.expr(
        f"(cast(weight as decimal(15,0)) * cast({budget} - taken as decimal(20,0)))"
        " div nullif(cast(all_weight - gone as decimal(18,0)), 0)"
    )
    given = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.greatest(F.lit(0), share)))
    helper = [f"{c}_wide" for c in wide] + ["used", "passed", "all_weight", "full", "taken", "gone"]
    return df.withColumn(out, given.cast("bigint")).drop(*helper)


def leaf_budgets(
    leaves: DataFrame, weights: Mapping[tuple[str | None, ...], int], budget: Column, max_epochs: int
) -> DataFrame:
    """Leaf rows (domain, lang, source, tokens) with their ``budget``; weight 0 gives no budget."""
    if max_epochs < 1:
        raise ValueError("max_epochs is 1 or more")
    df = leaves.withColumns({f"weight_{k}": weight_of(k, weights) for k in range(len(LEVELS))})
    alive = F.lit(True)
    for k in range(len(LEVELS)):
        alive = alive & (F.col(f"weight_{k}") > 0)
    df = df.filter(alive & (F.col("tokens") > 0)).withColumn("cap", F.col("tokens") * max_epochs)
    level = df.select(*LEVELS, "tokens", "cap", *[f"weight_{k}" for k in range(len(LEVELS))])
    budgets = None
    for k in range(len(LEVELS)):
        names, above = list(LEVELS[: k + 1]), list(LEVELS[:k])
        nodes = level.groupBy(*names).agg(F.sum("cap").alias("cap"), F.first(f"weight_{k}").alias("weight"))
        if budgets is None:
            nodes = nodes.withColumn("budget", budget)
        else:
            upper = budgets.select(*[F.col(c).alias(f"up_{c}") for c in above], "budget")
            same = F.lit(True)
            for c in above:
                same = same & F.col(c).eqNullSafe(F.col(f"up_{c}"))
            nodes = nodes.join(upper, same).drop(*[f"up_{c}" for c in above])
        budgets = split_budget(nodes, above, "budget", "given").select(*names, F.col("given").alias("budget"))
    same = F.lit(True)
    for c in LEVELS:
        same = same & F.col(c).eqNullSafe(F.col(f"up_{c}"))
    upper = budgets.select(*[F.col(c).alias(f"up_{c}") for c in LEVELS], "budget")
    return level.join(upper, same).select(*LEVELS, "tokens", "budget")


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    """A row's place in an epoch: rows are read by rising key, equal keys together."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null"))))


def plan_mix(
    rows: DataFrame,
    weights: Mapping[tuple[str | None, ...], int],
    share: float | None = None,
    budget: int | None = None,
    max_epochs: int = 1,
    key: str = "doc_id",
    seed: int = 0,
) -> Mix:
    """Budgets and cuts for rows (key, domain, lang, source, tokens).

    Give the budget in tokens, or as a share of all tokens there are. Keep ``rows`` slim and stored
    (:func:`slim`): it is read three times. Leaves, of which there are as many as sources, are
    aggregated before any shuffle; a leaf with a third of all rows adds one row per task, and the
    order inside it is found from the sums of 4096 buckets and the sorted rows of one bucket.
    """
    if (share is None) == (budget is None):
        raise ValueError("give a share or a budget")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("tokens").cast("bigint").alias("tokens")), "mix-leaves")
    if budget is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total * share)
    given = leaf_budgets(leaves, weights, F.lit(int(budget)).cast("bigint"), max_epochs)
    given = materialize(
        given.withColumn("epochs", F.expr("budget div tokens"))
        .withColumn("rest", F.expr("budget % tokens")),
        "mix-budgets",
    )
    partial = rows.alias("r").join(
        given.filter("rest > 0").select(*[F.col(c).alias(f"up_{c}") for c in LEVELS], "epochs", "rest"),
        _same_leaf(),
    )
    partial = partial.withColumn("order", order_key(seed, F.col("epochs"), F.col(f"`{key}`")))
    partial = partial.withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    leaf = [f"up_{c}" for c in LEVELS]
    running = Window.partitionBy(*leaf).orderBy("bucket")
    sums = partial.groupBy(*leaf, "bucket", "rest").agg(F.sum("tokens").cast("bigint").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(running))
    cut = sums.filter("upto > rest").groupBy(*leaf).agg(
        F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("cut")
    )
    cut = materialize(cut.select(*[F.col(c).alias(f"cut_{c}") for c in leaf], "cut"), "mix-cuts")
    same = F.lit(True)
    for c in leaf:
        same = same & F.col(c).eqNullSafe(F.col(f"cut_{c}"))
    edge = partial.join(cut, same).filter(F.col("bucket") == F.col("cut.bucket"))
    edge = edge.withColumn("upto", F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("order")))
    last = (
        edge.filter(F.col("upto") + F.col("cut.before") <= F.col("rest"))
        .groupBy(*leaf)
        .agg(F.max("order").alias("last"))
    )
    last = last.select(*[F.col(c).alias(f"last_{c}") for c in leaf], "last")
    same_last = F.lit(True)
    for c in leaf:
        same_last = same_last & F.col(f"cut_{c}").eqNullSafe(F.col(f"last_{c}"))
    # no row of the cut bucket fits: everything before it is taken, which is what its name says
    cuts = cut.join(last, same_last, "left").select(
        *[f"cut_{c}" for c in leaf], F.coalesce("last", "cut.bucket").alias("cut")
    )
    same_cut = F.lit(True)
    for c in LEVELS:
        same_cut = same_cut & F.col(c).eqNullSafe(F.col(f"cut_up_{c}"))
    done = given.join(cuts, same_cut, "left").select(
        *LEVELS, "tokens", "budget", "epochs", F.coalesce("cut", F.lit("")).alias("cut")
    )
    return Mix(materialize(done, "mix"), seed)


def _same_leaf() -> Column:
    same = F.lit(True)
    for c in LEVELS:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"up_{c}"))
    return same


def slim(df: DataFrame, key: str, domain: Column, tokens: Column) -> DataFrame:
    """The stored (key, domain, lang, source, tokens) of a table; null tokens count as none."""
    return materialize(
        df.select(
            F.col(f"`{key}`"), domain.cast("string").alias("domain"), "lang", "source",
            F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"),
        ),
        "mix-rows",
    )


def take(df: DataFrame, mix: Mix, domain: Column, key: str = "doc_id") -> DataFrame:
    """The rows the mix reads, once per epoch, with an ``epoch`` column (replaced if there).

    Whether a row is read follows from its own key and its leaf's row alone, so the table is joined
    only with the leaves. Rows without tokens, of leaves without budget or weight, are not read.
    Repeated rows share one key and are read, or not, together.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != "epoch"]
    own = spare_name(df, "domain")
    leaves = mix.leaves.select(
        *[F.col(c).alias(f"up_{c}") for c in LEVELS], F.col("epochs").alias("up_epochs"), F.col("cut").alias("up_cut")
    )
    same = (
        F.col(own).eqNullSafe(F.col("up_domain"))
        & F.col("lang").eqNullSafe(F.col("up_lang"))
        & F.col("source").eqNullSafe(F.col("up_source"))
    )
    joined = df.select(*kept, domain.cast("string").alias(own)).join(leaves, same)
    more = order_key(mix.seed, F.col("up_epochs"), F.col(f"`{key}`")) <= F.col("up_cut")
    times = (F.col("up_epochs") + more.cast("int")).cast("int")
    return joined.filter(times > 0).select(
        *kept, F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch")
    )
