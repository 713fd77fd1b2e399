import math
from contextlib import nullcontext
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallywright.operators import evaluation, grid_search, models, sampling
from tallywright.plans import inputs, studies
from tallywright.session import discard_stored, materialize, shared_dir, stored


@pytest.fixture(scope="module")
def ratings(spark, small):
    return models.mean_ratings(inputs.raw_ratings(spark, small)).persist()


@pytest.fixture(scope="module")
def als(ratings):
    return models.fit_als(ratings, rank=4, max_iter=4)


def test_pairs_are_unique(ratings):
    assert ratings.count() == ratings.select("userId", "movieId").distinct().count()


def test_same_seed_same_model(ratings, als):
    again = models.fit_als(ratings, rank=4, max_iter=4)
    first, second = (
        evaluation.rmse(models.predict_ratings(m, ratings), "rating").first()[0] for m in (als, again)
    )
    assert math.isfinite(first)
    assert math.isclose(first, second, rel_tol=1e-6)


def test_unseen_ids_are_dropped(spark, als):
    pairs = spark.createDataFrame([(10_000, 1, 3.0)], "userId int, movieId int, rating double")
    assert models.predict_ratings(als, pairs).count() == 0


def test_recommendations_are_distinct_and_falling(ratings, als):
    users = ratings.filter(F.col("userId") < 3)
    rows = models.recommend_for_users(als, users, 5).orderBy("userId", "rank").collect()
    by_user = {}
    for row in rows:
        by_user.setdefault(row.userId, []).append(row)
    for listed in by_user.values():
        assert [r["rank"] for r in listed] == [1, 2, 3, 4, 5]
        assert len({r.movieId for r in listed}) == 5
        assert all(b.score <= a.score for a, b in zip(listed, listed[1:]))


def test_search_returns_the_lowest_error(ratings):
    search = models.tune_als(ratings, {"rank": [2], "regParam": [0.1, 5.0], "maxIter": [2]}, folds=2)
    best = models.best_params(search)
    assert best["rmse"] == min(search.avgMetrics)
    assert best["regParam"] in (0.1, 5.0) and best["rank"] == 2


@pytest.mark.parametrize("block", [7, 2_048])
def test_recommendations_equal_products_of_the_factors(spark, ratings, als, block):
    """Every user's list against all products of the stored factors, and against the model's own."""
    users = {r.id: np.array(r.features, dtype=float) for r in als.userFactors.collect()}
    items = {r.id: np.array(r.features, dtype=float) for r in als.itemFactors.collect()}
    some = ratings.select("userId").union(spark.createDataFrame([(99_999,)], "userId int"))
    listed = {}
    for r in models.recommend_for_users(als, some, 7, block=block).collect():
        listed.setdefault(r.userId, {})[r["rank"]] = (r.movieId, r.score)
    assert listed.keys() == users.keys()
    own = {r.userId: r.recommendations for r in als.recommendForAllUsers(7).collect()}
    for user, found in listed.items():
        scores = {item: float(np.dot(users[user], x)) for item, x in items.items()}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:7]
        assert [found[k][0] for k in range(1, 8)] == best
        for k, item in enumerate(best):
            assert math.isclose(found[k + 1][1], scores[item], rel_tol=1e-9)
            assert math.isclose(own[user][k].rating, scores[item], rel_tol=1e-4, abs_tol=1e-5)


def test_search_table_has_every_setting(ratings):
    search = models.tune_als(ratings, {"rank": [1, 2], "regParam": [0.1], "maxIter": [2, 3]}, folds=2)
    rows = models.search_table(search).orderBy("place").collect()
    assert [(r["rank"], r.maxIter) for r in sorted(rows, key=lambda r: (r["rank"], r.maxIter))] == [(1, 2), (1, 3), (2, 2), (2, 3)]
    assert [r.rmse for r in rows] == sorted(search.avgMetrics) and [r.place for r in rows] == [1, 2, 3, 4]
    best = models.best_params(search)
    assert (rows[0]["rank"], rows[0].maxIter, rows[0].rmse) == (best["rank"], best["maxIter"], best["rmse"])


def test_training_rows_are_read_once_and_deleted(spark):
    """The rows behind a fit are computed once, however often the optimiser reads them."""
    rows = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: rows.add(1) or x, "double")
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("x"))
    train = VectorAssembler(inputCols=["y"], outputCol="features").transform(df.withColumn("y", seen("x")))
    for fit in (models.fit_linear_svm, models.fit_logistic, models.fit_random_forest):
        before = rows.value
        fit(train, "label")
        assert rows.value - before == 400
    left = [p.name for p in Path(shared_dir(spark)).iterdir() if p.name.startswith("training-")]
    assert left == []


@pytest.mark.parametrize("fit,name,most", [(models.fit_logistic, "LOGISTIC_ROWS", 50), (models.fit_random_forest, "FOREST_BINS", 50)])
def test_training_rows_are_dealt_by_number(spark, monkeypatch, fit, name, most):
    """A table stored in one small file goes to as many tasks as its rows ask for, evenly; a small one stays."""
    seen = []
    dealt = models._dealt

    def watched(*given):
        seen.append(dealt(*given))
        return seen[-1]

    monkeypatch.setattr(models, "_dealt", watched)
    df = spark.range(1200).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("x"))
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(df).coalesce(1)
    sizes = lambda: seen[-1].groupBy(F.spark_partition_id()).count().collect()
    with monkeypatch.context() as m:
        m.setattr(models, "stored", lambda rows, _: nullcontext(rows))
        fit(train, "label")
        assert len(sizes()) == 1
        m.setattr(models, name, most)
        fit(train, "label")
        assert len(sizes()) == 24 and max(r["count"] for r in sizes()) <= 1.2 * most


def test_stored_tables_can_be_discarded(spark):
    table = materialize(spark.range(5), "kept-for-now")
    assert table.count() == 5
    assert discard_stored(spark) > 0 and discard_stored(spark) == 0
    assert not [p for p in Path(shared_dir(spark)).iterdir() if p.name.startswith("kept-for-now")]
    with stored(spark.range(3), "for-a-block") as rows:
        assert rows.count() == 3
    assert not [p for p in Path(shared_dir(spark)).iterdir() if p.name.startswith("for-a-block")]


def test_settings_are_fitted_side_by_side(ratings, monkeypatch):
    """One setting for each task slot by default; the number changes no error."""
    used, build = [], models.CrossValidator
    monkeypatch.setattr(models, "CrossValidator", lambda **given: used.append(given["parallelism"]) or build(**given))
    grid = {"rank": [2], "regParam": [0.1, 5.0], "maxIter": [2]}
    wide, narrow = (models.tune_als(ratings, grid, folds=2, **given) for given in ({}, {"parallelism": 1}))
    assert used == [max(4, ratings.sparkSession.sparkContext.defaultParallelism), 1]
    assert np.allclose(wide.avgMetrics, narrow.avgMetrics, rtol=1e-9)


def test_search_in_tasks_equals_cross_validation(spark, ratings, monkeypatch):
    """Every error and deviation, the winner and its factors; repeated pairs, lone and rare users and items are among the rows."""
    odd = [(7, 3, 2.5), (7, 3, 4.0), (70_001, 3, 5.0), (70_001, 5, 1.5), (70_002, 90_001, 1.0), (-5, 4, 0.0)]
    rows = ratings.union(spark.createDataFrame(odd, "userId int, movieId int, rating double"))
    grid = {"rank": [12, 1], "regParam": [0.05, 2.0], "maxIter": [3, 1]}
    own = models.tune_als(rows, grid, folds=2)
    with monkeypatch.context() as m:
        m.setattr(grid_search, "TASK_VALUES", 1)
        other = models.tune_als(rows, grid, folds=2)
    assert len(own.avgMetrics) == 8 and np.allclose(own.avgMetrics, other.avgMetrics, rtol=1e-5)
    assert np.allclose(own.stdMetrics, other.stdMetrics, rtol=1e-3, atol=1e-6)
    assert models.best_params(own) == pytest.approx(models.best_params(other), rel=1e-5)
    x, y = ({r.id: r.features for r in s.bestModel.userFactors.collect()} for s in (own, other))
    assert x.keys() == y.keys() and all(np.allclose(x[k], y[k], rtol=1e-4, atol=1e-5) for k in x)
    assert models.search_table(own).count() == 8


def test_a_search_fits_once_for_all_iterations_and_penalties(ratings, monkeypatch):
    """``ALS`` runs once for each fold and rank, without iterations, and once for the winner."""
    fitted, fit = [], models.ALS._fit
    monkeypatch.setattr(models.ALS, "_fit", lambda als, df: fitted.append((als.getRank(), als.getMaxIter())) or fit(als, df))
    search = models.tune_als(ratings, {"rank": [2, 3], "regParam": [0.1, 5.0], "maxIter": [1, 2]}, folds=2)
    best = models.best_params(search)
    assert sorted(fitted[:-1]) == [(2, 0)] * 2 + [(3, 0)] * 2 and fitted[-1] == (best["rank"], best["maxIter"])


def test_rows_that_no_fit_takes_are_refused_as_before(spark, ratings):
    for rows in ([(1, None, 3.0)], [(1, 2, None)], [(1, 2, float("nan"))]):
        odd = ratings.union(spark.createDataFrame(rows, "userId int, movieId int, rating double"))
        with pytest.raises(Exception, match="(?i)null|nan|fold"):
            models.tune_als(odd, {"rank": [1], "regParam": [0.1], "maxIter": [1]}, folds=2)
    with pytest.raises(ValueError, match="empty"):
        models.tune_als(ratings.limit(1), {"rank": [1], "regParam": [0.1], "maxIter": [1]}, folds=2)


def test_full_grid_has_27_settings():
    assert math.prod(map(len, models.FULL_GRID.values())) == 27


def test_split_comparison(ratings):
    rows = models.compare_splits(ratings, rank=2, max_iter=2).orderBy("train_share").collect()
    assert [r.train_share for r in rows] == [0.7, 0.8]
    assert all(0 < r.mae <= r.rmse < 5 for r in rows)


def test_connection_study(spark, small):
    records = studies.read_connections(
        inputs.connection_lines(spark, small), inputs.CONNECTION_FIELDS
    )
    results = studies.study_connections(records)
    total = records.count()
    for name in ("protocols", "services", "labels", "flags", "bytes"):
        assert results[name].agg(F.sum("count")).first()[0] == total
    majority = records.filter("new_label = 'normal'").count() / total
    assert results["accuracy"].first()[0] > majority - 0.05
    assert 0 < results["f1"].first()[0] <= 1


def test_comment_study_learns_a_separable_class(spark):
    rows = [(f"buy cheap pills now {i} {'x' * (i % 7)}", 1.0, None, None) for i in range(40)]
    rows += [(f"lovely song thanks {'y' * (i % 9)} {i}", 0.0, None, None) for i in range(40)]
    rows += [("no class", None, None, None)]
    df = spark.createDataFrame(rows, "CONTENT string, CLASS double, DATE string, Column6 string")
    df = df.withColumn("id", F.monotonically_increasing_id()).repartition(3)
    results = studies.classify_comments(df, "id", trees=5, depth=3)
    shares = {r.model: r.value for r in results["comparison"].collect() if r.measure == "accuracy"}
    assert shares == {"logistic": 1.0, "forest": 1.0}
    report = {r["class"]: r for r in results["logistic_report"].collect()}
    assert report["1"].recall == 1.0
    assert report["accuracy"].support == math.ceil(0.2 * 80)
    alone = studies.classify_comments(df, "id", trees=2, depth=2, fit_on="train")
    assert alone["logistic"].count() == 16


def test_comment_profile(spark, small):
    results = studies.profile_comments(inputs.comments(spark, small))
    assert results["columns"].count() == 5
    assert results["lengths"].agg(F.sum("count")).first()[0] == inputs.comments(spark, small).count()
    assert results["terms"].count() == 20
    assert results["tfidf"].count() == 10


def test_linear_svm_separates(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(float(i > 50), Vectors.dense([i / 100, 1.0])) for i in range(100)]
    df = spark.createDataFrame(rows, ["label", "features"])
    model = models.fit_linear_svm(df, "label", max_iter=50)
    assert evaluation.accuracy(models.predict(model, df)).first()[0] > 0.9
    logistic = models.fit_logistic(df)
    assert logistic.getOrDefault("regParam") == 1 / 100


def test_split_by_hash_keeps_pairs_whole(ratings):
    train, test = sampling.split_by_hash(ratings, models.RATING_KEY, 0.8)
    assert train.join(test, list(models.RATING_KEY)).count() == 0
