"""Metrics over a (label, prediction) table, as plain aggregations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.session import materialize

#: Parts that the second list of classes is dealt into for the grid of a confusion matrix.
GRID_PARTS = 64


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error."""
    return regression_scores(df, label, prediction).select("rmse")


def mae(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean absolute error."""
    return regression_scores(df, label, prediction).select("mae")


def regression_scores(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """RMSE and MAE in one pass; taken alone, the optimizer prunes the other."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", zeros: bool = True
) -> DataFrame:
    """Rows per true and predicted class; with ``zeros`` also the pairs of classes that never meet.

    The rows that do meet are counted and stored once. The zero cells, as many as the square of the
    number of classes, are made by tasks from two lists of classes.
    """
    counts = _stored_counts(df, label, prediction)
    return _with_zeros(counts) if zeros else counts


def f1_weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per class, averaged by the number of true rows."""
    scores = _class_scores(df, label, prediction)
    return scores.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    A ratio with nothing below the line is 0. The accuracy row holds its value under ``f1``. One
    row per class and three more; no row gathers the others.
    """
    scores = _scores_of(_stored_counts(df, label, prediction))
    names = ["precision", "recall", "f1"]
    total = F.sum("support")
    summary = scores.agg(
        total.alias("total"),
        (F.sum("hits") / total).alias("accuracy"),
        F.struct(*[F.avg(name).alias(name) for name in names]).alias("macro"),
        F.struct(
            *[(F.sum(F.col(name) * F.col("support")) / total).alias(name) for name in names]
        ).alias("weighted"),
    )

    def row(title: str, *values: Column) -> Column:
        named = [value.cast("double").alias(name) for name, value in zip(names, values)]
        return F.struct(F.lit(title).alias("class"), *named, F.col("total").alias("support"))

    means = F.array(
        row("accuracy", F.lit(None), F.lit(None), F.col("accuracy")),
        row("macro avg", *[F.col("macro")[name] for name in names]),
        row("weighted avg", *[F.col("weighted")[name] for name in names]),
    )
    classes = scores.select(F.col("class").cast("string").alias("class"), *names, "support")
    return classes.unionByName(summary.select(F.inline(means)))


def compare_models(
    predictions: Mapping[str, DataFrame], label: str = "label", prediction: str = "prediction", zeros: bool = True
) -> DataFrame:
    """Accuracy and confusion cells of several models, ``(model, measure, label, prediction, value)``."""

    def one(name: str, df: DataFrame) -> DataFrame:
        counts = _stored_counts(df, label, prediction)
        hits = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
        nothing = F.lit(None).cast("string")
        share = counts.agg((F.sum(hits) / F.sum("count")).alias("value")).select(
            F.lit("accuracy").alias("measure"), nothing.alias("label"), nothing.alias("prediction"), "value"
        )
        cells = (_with_zeros(counts) if zeros else counts).select(
            F.lit("count").alias("measure"),
            F.col("label").cast("string").alias("label"),
            F.col("prediction").cast("string").alias("prediction"),
            F.col("count").cast("double").alias("value"),
        )
        return share.unionByName(cells).select(F.lit(name).alias("model"), "*")

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in predictions.items()])


def _pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction) in the label's type.

    A prediction that the label's type cannot hold, such as 0.7 for whole labels, is no class: it
    becomes null, and so a miss, never the class it would be rounded to.
    """
    held = F.col(prediction).try_cast(df.schema[label].dataType)
    whole = F.when(held == F.col(prediction), held)
    pairs = df.select(F.col(label).alias("label"), whole.alias("prediction"))
    return pairs.groupBy("label", "prediction").agg(F.count("*").alias("count"))


def _stored_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The pair counts as a table, so that predictions, which a model may have to compute, are made once."""
    return materialize(_pair_counts(df, label, prediction), "pair-counts")


def _with_zeros(counts: DataFrame) -> DataFrame:
    """The counts, and a zero for every pair of classes without one."""
    classes = counts.select(F.col("label").alias("class")).union(counts.select("prediction"))
    classes = classes.filter(F.col("class").isNotNull()).distinct()
    # each class meets each part of the list of classes, so a task makes the pairs of some of them
    part = F.pmod(F.xxhash64("class"), F.lit(GRID_PARTS)).cast("int").alias("__part")
    parts = F.explode(F.sequence(F.lit(0), F.lit(GRID_PARTS - 1))).alias("__part")
    grid = classes.select(F.col("class").alias("label"), parts).join(
        classes.select(F.col("class").alias("prediction"), part), "__part"
    )
    zeros = grid.select("label", "prediction", F.lit(0).cast("bigint").alias("count"))
    return counts.unionByName(zeros).groupBy("label", "prediction").agg(F.sum("count").alias("count"))


def _class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: hits, support, precision, recall and F1, from the pair counts alone."""
    return _scores_of(_pair_counts(df, label, prediction))


def _scores_of(counts: DataFrame) -> DataFrame:
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("count").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("count").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    totals = (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "hits")])
    )
    return totals.select(
        "class",
        "support",
        "hits",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below == 0, 0.0).otherwise(above / below)
