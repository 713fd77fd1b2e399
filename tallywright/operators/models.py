"""Recommender and classifiers from ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.functions.hashing import hash_number, hash_text
from tallywright.operators.evaluation import regression_scores
from tallywright.operators.grid_search import fold_errors
from tallywright.operators.sampling import split_by_hash
from tallywright.session import ensure_checkpointing, materialize, stored

#: Feature bins, of four bytes each, that a task of a forest holds; rows that one of a regression reads.
FOREST_BINS, LOGISTIC_ROWS = 1 << 26, 10_000
#: Users and items of a block of factors that a task multiplies.
BLOCK = 2_048
RATING_KEY = ("userId", "movieId")
# The full search grid.
FULL_GRID = {"rank": [10, 50, 100], "maxIter": [10, 15, 20], "regParam": [0.01, 0.1, 1.0]}


def mean_ratings(ratings: DataFrame) -> DataFrame:
    """One row per user and item, repeats averaged, so that a pair is never split or counted twice."""
    return ratings.groupBy(*RATING_KEY).agg(F.avg("rating").alias("rating"))


def fit_als(
    train: DataFrame,
    rank: int = 10,
    max_iter: int = 10,
    reg: float = 0.1,
    seed: int = 42,
    blocks: int | None = None,
) -> ALSModel:
    """Matrix factorisation of ``(userId, movieId, rating)``; unseen ids get no prediction.

    ``blocks`` is the number of user and item blocks; by default as many as there are task slots,
    within 10 to 1000. All ratings of one item are solved together, so average repeats first
    (:func:`mean_ratings`): an item then holds at most one row per user.
    """
    return _als(train, seed, blocks).setParams(rank=rank, maxIter=max_iter, regParam=reg).fit(train)


def predict_ratings(model: ALSModel | CrossValidatorModel, pairs: DataFrame) -> DataFrame:
    """Score user/item pairs; pairs with an unseen user or item are dropped."""
    return model.transform(pairs)


def compare_splits(
    ratings: DataFrame, train_shares: Sequence[float] = (0.7, 0.8), **als: object
) -> DataFrame:
    """Train and test at several shares: ``(train_share, rmse, mae)``."""
    scores = []
    for share in train_shares:
        train, test = split_by_hash(ratings, RATING_KEY, share)
        with stored(train, "training") as rows:
            predicted = predict_ratings(fit_als(rows, **als), test)
            errors = regression_scores(predicted, "rating").first()
        scores.append((float(share), errors.rmse, errors.mae))
    return ratings.sparkSession.createDataFrame(
        scores, "train_share double, rmse double, mae double"
    )


def tune_als(
    train: DataFrame,
    grid: Mapping[str, Sequence[float]] | None = None,
    folds: int = 3,
    seed: int = 42,
    parallelism: int | None = None,
    blocks: int | None = None,
) -> CrossValidatorModel:
    """Grid search by cross-validation; lowest RMSE wins. Default grid: all 27 settings.

    Folds follow a hash of user and item, so they do not depend on the partitioning. Ratings that fit
    in a task are searched by :func:`fold_errors`, whole fits side by side; the winner is fitted by
    ``ALS``. Others are left to ``CrossValidator``: ``parallelism`` is the number of settings fitted
    side by side, by default one for each task slot, at least 4: a fit is many short stages, and
    others fill the slots that a stage leaves idle.
    """
    slots = train.sparkSession.sparkContext.defaultParallelism
    als = _als(train, seed, blocks)
    builder = ParamGridBuilder()
    for name, values in (grid or FULL_GRID).items():
        builder = builder.addGrid(als.getParam(name), list(values))
    fold = F.pmod(hash_number(hash_text(RATING_KEY), 8), F.lit(folds)).cast("int")
    settings = builder.build()
    search = CrossValidator(
        estimator=als,
        estimatorParamMaps=settings,
        evaluator=RegressionEvaluator(
            metricName="rmse", labelCol="rating", predictionCol="prediction"
        ),
        numFolds=folds,
        foldCol="fold",
        seed=seed,
        parallelism=parallelism or max(4, slots),
    )
    dealt = train.withColumn("fold", fold)
    with stored(dealt.select(*RATING_KEY, "rating", "fold"), "search") as rows:
        errors = fold_errors(als, settings, rows, folds, search.getParallelism())
    if errors is None:
        return search.fit(dealt)
    mean, spread = errors.mean(axis=0), errors.std(axis=0)
    best = als.fit(dealt, settings[int(mean.argmin())])
    return search._copyValues(CrossValidatorModel(best, mean.tolist(), stdMetrics=spread.tolist()))


def search_table(search: CrossValidatorModel) -> DataFrame:
    """``(rank, maxIter, regParam, rmse, deviation, place)``: every setting, place 1 the best.

    The error is the mean over the folds, the deviation its standard deviation; ties in the order
    of the grid. Parameters that the grid does not vary have the value they were fitted with.
    """
    als = search.getEstimator()
    rows = []
    for given, mean, spread in zip(search.getEstimatorParamMaps(), search.avgMetrics, search.stdMetrics):
        params = {p.name: v for p, v in {**als.extractParamMap(), **given}.items()}
        rows.append((int(params["rank"]), int(params["maxIter"]), float(params["regParam"]), float(mean), float(spread)))
    order = sorted(range(len(rows)), key=lambda i: rows[i][3])
    ranked = [(*rows[i], place + 1) for place, i in enumerate(order)]
    return SparkSession.active().createDataFrame(
        ranked, "rank int, maxIter int, regParam double, rmse double, deviation double, place int"
    )


def best_params(search: CrossValidatorModel) -> dict[str, float]:
    """The winning setting and its mean RMSE."""
    place = min(range(len(search.avgMetrics)), key=search.avgMetrics.__getitem__)
    params = {p.name: value for p, value in search.getEstimatorParamMaps()[place].items()}
    return {**params, "rmse": float(search.avgMetrics[place])}


def recommend_for_users(model: ALSModel, users: DataFrame, n: int = 12, block: int = BLOCK) -> DataFrame:
    """Top n items per listed user, ``(userId, rank, movieId, score)``; rated items may appear.

    Blocks of users meet blocks of items, each pair multiplied in one task that hands on n items
    for each user; the best of all blocks are ranked. Ties go to the lower item. Users that the
    model does not know have no list.
    """
    if n < 1:
        raise ValueError("n from 1")
    asked = model.userFactors.join(users.select(F.col("userId").alias("id")).distinct(), "id")
    asked, items = (materialize(df.select("id", "features"), name) for df, name in ((asked, "users"), (model.itemFactors, "items")))
    blocks, parts = (max(1, math.ceil(df.count() / block)) for df in (items, asked))

    def dealt(df: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
        return df.withColumn(own, part).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    left = dealt(asked, "part", parts, "block", blocks).groupBy("part", "block")
    right = dealt(items, "block", blocks, "part", parts).groupBy("part", "block")
    found = left.cogroup(right).applyInArrow(_best_products(n), "userId int, movieId int, score double")
    order = Window.partitionBy("userId").orderBy(F.desc("score"), "movieId")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select("userId", "rank", "movieId", "score")


def _best_products(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The n best items of each user among those of one block."""
    schema = pa.schema([("userId", pa.int32()), ("movieId", pa.int32()), ("score", pa.float64())])

    def best(users: pa.Table, items: pa.Table) -> pa.Table:
        if not users.num_rows or not items.num_rows:
            return schema.empty_table()
        items = items.sort_by("id")
        u, v = (np.array(side["features"].to_pylist(), dtype=np.float64) for side in (users, items))
        scores = np.zeros((len(u), len(v)))
        for x, y in zip(u.T, v.T, strict=True):  # in one order, so that equal factors tie
            scores += x[:, None] * y[None, :]
        place = np.argsort(-scores, axis=1, kind="stable")[:, :n]
        return pa.table(
            [np.repeat(users["id"].to_numpy(), place.shape[1]), items["id"].to_numpy()[place.ravel()],
             np.take_along_axis(scores, place, axis=1).ravel()],
            schema=schema,
        )

    return best


def fit_linear_svm(
    train: DataFrame, label: str = "label_indexed", features: str = "features", max_iter: int = 10
) -> LinearSVCModel:
    """Linear support vector machine. The training rows are stored for the fit, which reads them often."""
    with stored(train.select(label, features), "training") as rows:
        return LinearSVC(labelCol=label, featuresCol=features, maxIter=max_iter).fit(rows)


def fit_logistic(
    train: DataFrame, label: str = "label", features: str = "features", strength: float = 1.0
) -> LogisticRegressionModel:
    """L2 logistic regression. ``strength`` is C in ``C * summed loss + |w|^2 / 2``.

    MLlib minimises the *mean* loss, hence the penalty ``1 / (C * rows)``. The training rows are
    stored for the fit and dealt over tasks of ``LOGISTIC_ROWS``, as each step passes over all of them.
    """
    with stored(train.select(label, features), "training") as rows:
        count = rows.count()
        return LogisticRegression(
            labelCol=label,
            featuresCol=features,
            regParam=1.0 / (strength * count),
            elasticNetParam=0.0,
            standardization=False,
        ).fit(_dealt(rows, count, LOGISTIC_ROWS))


def fit_random_forest(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> RandomForestClassificationModel:
    """Random forest; depth is bounded (30 at most), trees use a root share of the features.

    The training rows are stored for the fit, which holds a bin for every feature of every row, zero
    or not; they are dealt over as many tasks as keep that within ``FOREST_BINS`` for each.
    """
    ensure_checkpointing(train.sparkSession)
    with stored(train.select(label, features), "training") as rows:
        first = rows.select(features).first()
        width = first[0].size if first and first[0] is not None else 1
        return RandomForestClassifier(
            labelCol=label,
            featuresCol=features,
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
            featureSubsetStrategy="sqrt",
            cacheNodeIds=True,
        ).fit(_dealt(rows, rows.count(), max(1, FOREST_BINS // max(1, width))))


def _dealt(rows: DataFrame, count: int, most: int) -> DataFrame:
    """The rows dealt evenly over all task slots, and no more than about ``most`` to a task; so few rows stay.

    Stored rows are split by their packed size, which says little about what a fit makes of them.
    """
    slots = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(slots, math.ceil(count / most))) if count > most else rows


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add the prediction and the raw score columns."""
    return model.transform(df)


def _als(train: DataFrame, seed: int, blocks: int | None) -> ALS:
    ensure_checkpointing(train.sparkSession)
    slots = train.sparkSession.sparkContext.defaultParallelism
    blocks = blocks or min(max(10, slots), 1000)
    return ALS(
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        coldStartStrategy="drop",
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
