"""The end-to-end jobs: text in, result tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.operators import aggregates, columns, evaluation, features, models
from tallywright.operators import profile, ranking, sampling, text
from tallywright.operators.clustering import KMeansResult, kmeans_fit
from tallywright.session import materialize
from tallywright.sources import read_lines, read_points, read_positional, read_seeds, write_kv

# Field positions of a connection record, and the words counted by default.
CONNECTION_ORDINALS = {
    "duration": 0,
    "protocol_type": 1,
    "service": 2,
    "flag": 3,
    "src_bytes": 4,
    "dst_bytes": 5,
    "label": 41,
}
SELECTED_WORDS = [
    "Shakespeare",
    "When",
    "Lord",
    "Library",
    "GUTENBERG",
    "WILLIAM",
    "COLLEGE",
    "WORLD",
]
# Category columns, and columns of the feature vector in their order.
CONNECTION_CATEGORIES = ["protocol_type", "service", "flag", "new_label"]
CONNECTION_VECTOR = [
    "duration",
    "protocol_type_indexed",
    "service_indexed",
    "src_bytes",
    "dst_bytes",
    "flag_indexed",
]


def count_lines(spark: SparkSession, source: str, target: str) -> None:
    """Write ``line<TAB>n``."""
    write_kv(aggregates.line_count(read_lines(spark, source)), target)


def cluster_points(
    spark: SparkSession, source: str, target: str, seeds: str, k: int, max_iter: int = 15
) -> KMeansResult:
    """k-means over comma-separated points; centroids of iteration i go to ``<target>_i``."""
    points = read_points(read_lines(spark, source))
    result = kmeans_fit(points, read_seeds(spark, seeds, k), max_iter)
    history = result.history()
    for iteration in range(len(result.milliseconds)):
        step = history.filter(F.col("iteration") == iteration).orderBy("cid")
        write_kv(step.coalesce(1), f"{target}_{iteration}", "cid", "c")
    return result


def pick_seeds(spark: SparkSession, source: str, target: str, k: int, seed: str = "0") -> None:
    """Write k lines of a point file, drawn without replacement, as a seed file.

    Equal lines are numbered first, so that each copy has a chance of its own.
    """
    lines = read_lines(spark, source)
    copies = lines.groupBy("value").agg(F.count("*").alias("copies"))
    numbered = copies.select("value", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    drawn = sampling.sample_seeds(numbered, ["value", "copy"], k, seed)
    drawn.select("value").coalesce(1).write.text(target)


def count_parity(spark: SparkSession, source: str) -> DataFrame:
    """Even and odd integers of a text file."""
    lines = read_lines(spark, source)
    whole = lines.select(F.when(F.col("value").rlike(r"^\s*[+-]?[0-9]+\s*$"), F.col("value")).alias("value"))
    numbers = columns.cast_columns(whole, {"value": "decimal(38,0)"})
    return aggregates.parity_count(numbers, "value")


def sum_salaries(spark: SparkSession, source: str) -> DataFrame:
    """Salary sum per department of ``department salary`` lines."""
    rows = columns.split_fields(
        read_lines(spark, source), " ", {"department": (0, "string"), "salary": (1, "float")}
    )
    return aggregates.sum_by(rows, "department", "salary")


def study_words(
    spark: SparkSession,
    source: str,
    target: str,
    words: Sequence[str] = tuple(SELECTED_WORDS),
    n: int = 15,
) -> dict[str, DataFrame]:
    """Counts of listed words, and the most and least frequent words.

    All counts are kept as a table at ``target``, from which both reports are taken.
    """
    lines = read_lines(spark, source)
    aggregates.word_count(lines).write.mode("errorifexists").parquet(target)
    counts = spark.read.parquet(target)
    return {
        "selected": aggregates.selected_word_count(lines, "value", list(words)),
        "top": ranking.top_words(counts, n),
        "bottom": ranking.bottom_words(counts, n),
    }


def study_ratings(
    ratings: DataFrame,
    users: Sequence[int] = (10, 12),
    grid: Mapping[str, Sequence[float]] | None = None,
    folds: int = 3,
    n: int = 12,
) -> dict[str, DataFrame]:
    """Averages, split comparison, grid search and recommendations of a ratings table."""
    spark = ratings.sparkSession
    pairs = materialize(models.mean_ratings(ratings), "ratings")
    train, test = sampling.split_by_hash(pairs, models.RATING_KEY, 0.8)
    search = models.tune_als(train, grid, folds)
    best = models.best_params(search)
    tuned = evaluation.regression_scores(models.predict_ratings(search, test), "rating").first()
    listed = spark.createDataFrame([(user,) for user in users], "userId int")
    known = listed.join(train.select("userId").distinct(), "userId", "left_semi")
    return {
        "describe": profile.describe_table(ratings),
        "top_items": ranking.top_rated(ratings, "movieId", n=n),
        "top_users": ranking.top_rated(ratings, "userId", n=n),
        "splits": models.compare_splits(pairs),
        "tuned": spark.createDataFrame(
            [(int(best["rank"]), int(best["maxIter"]), float(best["regParam"]), tuned.rmse)],
            "rank int, maxIter int, regParam double, rmse double",
        ),
        "recommendations": models.recommend_for_users(search.bestModel, known, n),
    }


def read_connections(
    lines: DataFrame, ordinals: Mapping[str, int] = CONNECTION_ORDINALS
) -> DataFrame:
    """Connection records with a binary label and numeric duration and byte columns."""
    labelled = columns.binarize_label(read_positional(lines, ordinals), "label")
    return columns.cast_columns(
        labelled, {"duration": "double", "src_bytes": "double", "dst_bytes": "double"}
    )


def study_connections(
    records: DataFrame, seed: int = 42, invalid: str = "skip"
) -> dict[str, DataFrame]:
    """Group counts, byte densities and a linear SVM over connection records.

    ``invalid`` says what becomes of records with a null feature: ``skip`` leaves them out of the
    model and its scores (not out of the counts), ``error`` stops at one, ``keep`` takes them as NaN.
    """
    # a filter on the hash of whole records would parse each line again for every field
    records = materialize(records, "records")
    fitted = features.fit_features(
        records, CONNECTION_CATEGORIES, CONNECTION_VECTOR, invalid=invalid
    )

    def ready(part: DataFrame) -> DataFrame:
        return fitted.transform(part).select(
            "new_label", F.col("new_label_indexed").alias("label_indexed"), "features"
        )

    # equal records stay on one side
    train, test = sampling.split_by_hash(records, records.columns, 0.8, str(seed))
    scored = materialize(models.predict(models.fit_linear_svm(ready(train)), ready(test)), "scored")
    return {
        "protocols": aggregates.count_by(records, "protocol_type"),
        "services": aggregates.count_by(records, "service"),
        "labels": aggregates.count_by(records, "label", ascending=False),
        "flags": aggregates.count_by(records, "flag", ascending=False),
        "bytes": aggregates.log_density(records, "src_bytes", "dst_bytes", "label"),
        "palette": aggregates.label_palette_keys(records, "label"),
        "predictions": scored.select("new_label", "label_indexed", "prediction", "rawPrediction"),
        "accuracy": evaluation.accuracy(scored, "label_indexed"),
        "f1": evaluation.f1_weighted(scored, "label_indexed"),
    }


def prepare_comments(comments: DataFrame) -> DataFrame:
    """Labelled comments, cleaned and free of repeated rows."""
    labelled = columns.drop_null_rows(comments, ["CLASS"])
    slim = columns.drop_columns(labelled, ["DATE", "Column6"])
    typed = columns.cast_columns(slim, {"CLASS": "int"})
    return aggregates.drop_duplicate_rows(text.clean_text(typed, "CONTENT"))


def profile_comments(
    comments: DataFrame, stop_words: str | Sequence[str] | None = "english", spam: object = 1
) -> dict[str, DataFrame]:
    """What the raw comment table looks like before cleaning."""
    sized = text.token_length(comments, "CONTENT")
    return {
        "columns": profile.profile_columns(comments),
        "percentiles": profile.describe_percentiles(comments),
        "classes": aggregates.count_by(comments, "CLASS", ascending=False, drop_nulls=True),
        "lengths": profile.histogram(sized, "comment_length", 30),
        "terms": ranking.top_terms_by_class(comments, "CONTENT", "CLASS", 10, stop_words),
        "cloud": ranking.term_weights(comments, "CONTENT", "CLASS", spam, 200, stop_words),
        "tfidf": features.mean_tfidf_by_class(
            comments, "CONTENT", "CLASS", spam, 10, 100, stop_words
        ),
    }


def classify_comments(
    comments: DataFrame,
    key: str | Sequence[str] = ("CONTENT", "CLASS"),
    max_features: int = 5000,
    trees: int = 100,
    depth: int = 10,
    fit_on: str = "all",
) -> dict[str, DataFrame]:
    """Logistic regression and random forest on TF-IDF vectors, compared on an exact 20 % split.

    With ``fit_on='all'`` the vocabulary sees the test rows too, which leaks a little of them into
    training; ``fit_on='train'`` fits it on the training rows alone.
    """
    if fit_on not in {"all", "train"}:
        raise ValueError("fit_on must be 'all' or 'train'")
    ready = materialize(prepare_comments(comments), "comments")
    train_text, test_text = sampling.split_exact(ready, key)
    fitted = features.fit_tfidf(ready if fit_on == "all" else train_text, "CONTENT", max_features)
    train = fitted.vectors(train_text, "CONTENT").select("CLASS", "features")
    logistic = models.fit_logistic(train, "CLASS")
    forest = models.fit_random_forest(train, "CLASS", trees=trees, depth=depth)
    test = fitted.vectors(test_text, "CONTENT").select("CLASS", "features")
    scored = {
        "logistic": materialize(models.predict(logistic, test), "logistic"),
        "forest": materialize(models.predict(forest, test), "forest"),
    }
    reports = {
        f"{name}_report": evaluation.classification_report(table, "CLASS")
        for name, table in scored.items()
    }
    return {**reports, "comparison": evaluation.compare_models(scored, "CLASS"), **scored}
