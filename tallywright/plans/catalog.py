"""One query per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions.numeric import finite
from tallywright.operators import aggregates, columns, evaluation, features, models
from tallywright.operators import profile, ranking, sampling, text
from tallywright.operators.clustering import (
    assign_nearest,
    cluster_sizes,
    kmeans_fit,
    kmeans_history,
    recompute_centroids,
)
from tallywright.plans import inputs, studies
from tallywright.session import materialize, shared_path
from tallywright.sources import (
    read_centroids,
    read_checked_csv,
    read_lines,
    read_points,
    read_positional,
    read_seeds,
    read_table_csv,
    spread,
    write_kv,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEEDS = 5
SELECTED = ["the", "The", "and", "de", "est", "nowhere-in-the-text"]
LONG_REPORT = 12_000
#: Rows with a lower key hash than "hot" and half of the rows with that key, as a share of all.
HOT_SHARE = 0.269
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _planar(df: DataFrame, *keep: str) -> DataFrame:
    """Two coordinates of an array column ``c``, rounded."""
    return df.select(
        *keep, F.round(df.c[0], 6).alias("cx"), F.round(df.c[1], 6).alias("cy")
    )


# Sources and sinks


@query
def read_lines_gzip(spark, sf_dir):
    path = shared_path(spark, "lines")
    inputs.lines(spark, sf_dir).write.text(path, compression="gzip")
    return read_lines(spark, path, partitions=spark.sparkContext.defaultParallelism)


@query
def read_table_csv_ratings(spark, sf_dir):
    path = shared_path(spark, "ratings")
    inputs.raw_ratings(spark, sf_dir).write.csv(path, header=True)
    return read_table_csv(spark, path, "userId int, movieId int, rating double")


@query
def read_table_csv_comments(spark, sf_dir):
    path = shared_path(spark, "comments")
    comments = inputs.comments(spark, sf_dir).select("doc_id", "CONTENT", "CLASS")
    comments.write.csv(path, header=True, escape='"', quoteAll=True)
    schema = "doc_id bigint, CONTENT string, CLASS double"
    return read_table_csv(spark, path, schema, multi_line=True)


def _checked_ratings(spark, sf_dir):
    path = shared_path(spark, "rating-lines")
    inputs.rating_lines(spark, sf_dir).coalesce(1).write.text(path)
    return read_checked_csv(spark, path, sample_lines=inputs.CLEAN_LINES)


@query
def read_checked_csv_rows(spark, sf_dir):
    """Types inferred from the first lines; lines that do not fit them are left out."""
    return _checked_ratings(spark, sf_dir)[0]


@query
def read_checked_csv_malformed(spark, sf_dir):
    return _checked_ratings(spark, sf_dir)[1]


@query
def read_positional_fields(spark, sf_dir):
    return read_positional(inputs.connection_lines(spark, sf_dir), inputs.CONNECTION_FIELDS)


@query
def read_points_planar(spark, sf_dir):
    points = read_points(inputs.point_lines(spark, sf_dir), out="c")
    return _planar(points, *inputs.LINE_KEY)


@query
def read_seeds_file(spark, sf_dir):
    path = shared_path(spark, "seeds")
    first = inputs.point_lines(spark, sf_dir).orderBy(*inputs.LINE_KEY).limit(8)
    first.select("value").coalesce(1).write.text(path)
    return _planar(read_seeds(spark, path, SEEDS), "cid")


@query
def read_centroids_file(spark, sf_dir):
    path = shared_path(spark, "centroids")
    result = _fit(spark, sf_dir, 1)
    write_kv(result.centroid_table(), path)
    return _planar(read_centroids(spark, path), "cid")


@query
def write_kv_words(spark, sf_dir):
    path = shared_path(spark, "words")
    write_kv(aggregates.word_count(inputs.lines(spark, sf_dir)), path)
    return read_lines(spark, path)


@query
def preview(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return ranking.preview(documents, "doc_id", 10)


# Projections, filters, conditional columns


@query
def split_fields(spark, sf_dir):
    spec = {"department": (0, "string"), "salary": (1, "float")}
    rows = columns.split_fields(inputs.salaries(spark, sf_dir), " ", spec)
    return rows.withColumn("salary", F.round(F.col("salary").cast("double"), 4))


@query
def field_count(spark, sf_dir):
    return columns.field_count(inputs.lines(spark, sf_dir))


@query
def parity_label(spark, sf_dir):
    numbers = columns.cast_columns(inputs.integers(spark, sf_dir), {"value": "bigint"})
    return columns.parity_label(numbers, "value")


@query
def binarize_label(spark, sf_dir):
    rows = read_positional(inputs.connection_lines(spark, sf_dir), inputs.CONNECTION_FIELDS)
    return columns.binarize_label(rows, "label").select("service", "label", "new_label")


@query
def cast_columns(spark, sf_dir):
    return _records(spark, sf_dir).select("duration", "src_bytes", "dst_bytes", "label")


@query
def drop_columns(spark, sf_dir):
    return columns.drop_columns(inputs.comments(spark, sf_dir), ["DATE", "Column6"])


@query
def drop_null_rows(spark, sf_dir):
    kept = columns.drop_null_rows(inputs.comments(spark, sf_dir), ["CLASS"])
    return columns.cast_columns(kept, {"CLASS": "int"}).select("doc_id", "CONTENT", "CLASS")


@query
def filter_nonempty(spark, sf_dir):
    pieces = inputs.documents(spark, sf_dir).select(
        "doc_id", F.explode(F.split("text", " ")).alias("piece")
    )
    return columns.filter_nonempty(pieces, "piece")


@query
def filter_class(spark, sf_dir):
    spam = columns.filter_class(inputs.comments(spark, sf_dir), "CLASS", 1)
    return spam.select("doc_id", "CONTENT", "CLASS")


# Text


@query
def tokenize_ws(spark, sf_dir):
    return text.tokenize_ws(inputs.documents(spark, sf_dir), "text", keep=["doc_id"])


@query
def tokenize_terms(spark, sf_dir):
    return text.tokenize_terms(inputs.texts(spark, sf_dir), "CONTENT", ["doc_id"])


@query
def tokenize_terms_without_stop_words(spark, sf_dir):
    comments = inputs.texts(spark, sf_dir)
    return text.tokenize_terms(comments, "CONTENT", ["doc_id"], stop_words="english")


@query
def token_length(spark, sf_dir):
    comments = inputs.texts(spark, sf_dir)
    return text.token_length(comments, "CONTENT").select("doc_id", "comment_length")


@query
def clean_text(spark, sf_dir):
    return text.clean_text(inputs.texts(spark, sf_dir), "CONTENT").select("doc_id", "CONTENT")


# Aggregations


@query
def line_count(spark, sf_dir):
    return aggregates.line_count(inputs.table(spark, sf_dir, "documents"))


@query
def count_by_protocol(spark, sf_dir):
    return aggregates.count_by(_raw_records(spark, sf_dir), "protocol_type")


@query
def count_by_service(spark, sf_dir):
    return aggregates.count_by(_raw_records(spark, sf_dir), "service")


@query
def count_by_label(spark, sf_dir):
    return aggregates.count_by(_raw_records(spark, sf_dir), "label", ascending=False)


@query
def count_by_flag(spark, sf_dir):
    return aggregates.count_by(_raw_records(spark, sf_dir), "flag", ascending=False)


@query
def count_by_class(spark, sf_dir):
    comments = inputs.comments(spark, sf_dir)
    return aggregates.count_by(comments, "CLASS", ascending=False, drop_nulls=True)


@query
def parity_count(spark, sf_dir):
    numbers = columns.cast_columns(inputs.integers(spark, sf_dir), {"value": "bigint"})
    return aggregates.parity_count(numbers, "value")


@query
def sum_by(spark, sf_dir):
    spec = {"department": (0, "string"), "salary": (1, "float")}
    rows = columns.split_fields(inputs.salaries(spark, sf_dir), " ", spec)
    return _rounded(aggregates.sum_by(rows, "department", "salary"), "salary_sum", digits=4)


@query
def avg_by_item(spark, sf_dir):
    means = aggregates.avg_by(inputs.raw_ratings(spark, sf_dir), "movieId", "rating")
    return _rounded(means, "avg_rating")


@query
def selected_word_count(spark, sf_dir):
    return aggregates.selected_word_count(inputs.lines(spark, sf_dir), "value", SELECTED)


@query
def word_count(spark, sf_dir):
    return aggregates.word_count(inputs.lines(spark, sf_dir))


@query
def describe_table(spark, sf_dir):
    ratings = inputs.raw_ratings(spark, sf_dir)
    return _rounded(profile.describe_table(ratings), "mean", "stddev")


@query
def describe_percentiles(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem")
    return _rounded(profile.describe_percentiles(rows), "mean", "std", "p25", "p50", "p75")


@query
def profile_columns(spark, sf_dir):
    return profile.profile_columns(inputs.comments(spark, sf_dir))


@query
def drop_duplicate_rows(spark, sf_dir):
    return studies.prepare_comments(inputs.comments(spark, sf_dir).drop("doc_id"))


@query
def histogram(spark, sf_dir):
    sized = text.token_length(inputs.texts(spark, sf_dir), "CONTENT")
    return _rounded(profile.histogram(sized, "comment_length", 30), "left", "right")


@query
def log_density(spark, sf_dir):
    return aggregates.log_density(_records(spark, sf_dir), "src_bytes", "dst_bytes", "label", 4)


@query
def label_palette_keys(spark, sf_dir):
    return aggregates.label_palette_keys(_raw_records(spark, sf_dir), "label")


# Top-k


@query
def top_words(spark, sf_dir):
    return ranking.top_words(aggregates.word_count(inputs.lines(spark, sf_dir)))


@query
def top_words_long(spark, sf_dir):
    """A report longer than one task may rank."""
    return ranking.top_words(aggregates.word_count(inputs.lines(spark, sf_dir)), LONG_REPORT)


@query
def top_terms_by_class_long(spark, sf_dir):
    comments = inputs.comments(spark, sf_dir)
    return ranking.top_terms_by_class(
        comments, "CONTENT", "CLASS", LONG_REPORT, max_features=LONG_REPORT
    )


@query
def bottom_words(spark, sf_dir):
    return ranking.bottom_words(aggregates.word_count(inputs.lines(spark, sf_dir)))


@query
def top_rated_items(spark, sf_dir):
    return _rounded(ranking.top_rated(inputs.raw_ratings(spark, sf_dir), "movieId"), "avg_rating")


@query
def top_rated_users(spark, sf_dir):
    return _rounded(ranking.top_rated(inputs.raw_ratings(spark, sf_dir), "userId"), "avg_rating")


@query
def top_terms_by_class(spark, sf_dir):
    return ranking.top_terms_by_class(inputs.comments(spark, sf_dir), "CONTENT", "CLASS")


@query
def term_weights(spark, sf_dir):
    weights = ranking.term_weights(inputs.comments(spark, sf_dir), "CONTENT", "CLASS", 1)
    return _rounded(weights, "weight")


# Features


@query
def tfidf_long_small(spark, sf_dir):
    comments = inputs.texts(spark, sf_dir)
    weights = features.tfidf_long(comments, "CONTENT", ["doc_id"], 100, "english")
    return _rounded(weights, "weight")


@query
def tfidf_long(spark, sf_dir):
    cleaned = text.clean_text(inputs.texts(spark, sf_dir), "CONTENT")
    return _rounded(features.tfidf_long(cleaned, "CONTENT", ["doc_id"], 5000), "weight")


@query
def mean_tfidf_by_class(spark, sf_dir):
    comments = inputs.comments(spark, sf_dir)
    return _rounded(features.mean_tfidf_by_class(comments, "CONTENT", "CLASS", 1), "score")


@query
def tfidf_vectors(spark, sf_dir):
    cleaned = text.clean_text(inputs.texts(spark, sf_dir), "CONTENT")
    return _vector_totals(features.tfidf_vectors(cleaned, "CONTENT", 5000))


def _vector_totals(vectors):
    vector = F.unwrap_udt("features")
    return vectors.select(
        "doc_id",
        F.size(vector["indices"]).alias("terms"),
        F.round(
            F.aggregate(vector["values"], F.lit(0.0), lambda total, weight: total + weight), 6
        ).alias("total"),
    )


#: Settings under which no vocabulary is broadcast and hot terms are those with a 200th of the rows.
BY_TABLE = {"broadcast_terms": 0, "hot_terms": 200}


@query
def tfidf_long_from_table(spark, sf_dir):
    cleaned = text.clean_text(inputs.texts(spark, sf_dir), "CONTENT")
    return _rounded(features.tfidf_long(cleaned, "CONTENT", ["doc_id"], 5000, **BY_TABLE), "weight")


@query
def tfidf_long_of_all_terms(spark, sf_dir):
    comments = inputs.texts(spark, sf_dir)
    return _rounded(features.tfidf_long(comments, "CONTENT", ["doc_id"], None), "weight")


@query
def tfidf_vectors_from_table(spark, sf_dir):
    cleaned = text.clean_text(inputs.texts(spark, sf_dir), "CONTENT")
    return _vector_totals(features.tfidf_vectors(cleaned, "CONTENT", 5000, **BY_TABLE))


@query
def mean_tfidf_by_class_from_table(spark, sf_dir):
    comments = inputs.comments(spark, sf_dir)
    return _rounded(features.mean_tfidf_by_class(comments, "CONTENT", "CLASS", 1, **BY_TABLE), "score")


@query
def index_many_categories(spark, sf_dir):
    """Part keys go by shuffle past the broadcast limit; a third of the rows share one of them."""
    part = F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_partkey").cast("string"))
    rows = inputs.table(spark, sf_dir, "lineitem").select(part.alias("part"), "l_suppkey")
    indexed = features.index_categories(rows, ["part", "l_suppkey"], hot_keys=100)
    return indexed.groupBy("part", "part_indexed", "l_suppkey", "l_suppkey_indexed").agg(F.count("*").alias("count"))


@query
def index_categories(spark, sf_dir):
    names = ["protocol_type", "service", "flag", "new_label"]
    indexed = features.index_categories(_records(spark, sf_dir), names)
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(name).alias("category"),
                F.col(name + "_indexed").alias("place"),
            )
            for name in names
        ]
    )
    rows = indexed.select(F.inline(pairs))
    return rows.groupBy("column", "category", "place").agg(F.count("*").alias("count"))


@query
def assemble_features(spark, sf_dir):
    names = ["duration", "src_bytes", "dst_bytes"]
    assembled = features.assemble_features(_records(spark, sf_dir), names)
    values = vector_to_array("features")
    return assembled.select(*[F.get(values, F.lit(i)).alias(f"f{i}") for i in range(3)])


@query
def fit_features(spark, sf_dir):
    records = _records(spark, sf_dir)
    fitted = features.fit_features(
        records, studies.CONNECTION_CATEGORIES, studies.CONNECTION_VECTOR
    )
    ready = fitted.transform(records).withColumnRenamed("new_label_indexed", "label_indexed")
    values = vector_to_array("features")
    width = len(studies.CONNECTION_VECTOR)
    entries = ready.select(
        "label_indexed", *[F.get(values, F.lit(i)).alias(f"f{i}") for i in range(width)]
    )
    return entries.groupBy("label_indexed").agg(
        F.count("*").alias("count"),
        *[F.round(F.sum(f"f{i}"), 2).alias(f"sum_f{i}") for i in range(width)],
    )


# Splits and samples


@query
def split_random(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY)
    train, test = sampling.split_random(rows, [0.8, 0.2], 42)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def split_by_hash(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY)
    train, test = sampling.split_by_hash(rows, inputs.LINE_KEY, 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def split_by_hash_with_null_keys(spark, sf_dir):
    """A key that a part of the rows does not have; both parts add up to the table."""
    key = F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")).alias("key")
    rows = inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY, key)
    train, test = sampling.split_by_hash(rows, "key", 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def split_exact(spark, sf_dir):
    rows = spread(inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY), *inputs.LINE_KEY)
    train, test = sampling.split_exact(rows, inputs.LINE_KEY, 0.2)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def split_exact_hot_key(spark, sf_dir):
    """A third of the rows share the key at which the test part ends."""
    key = F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_orderkey").cast("string"))
    rows = inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY, key.alias("key"))
    train, test = sampling.split_exact(rows, "key", HOT_SHARE)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def split_exact_equal_rows(spark, sf_dir):
    """Rows of three values only: how many of each go to either part."""
    rows = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag")
    train, test = sampling.split_exact(rows, "l_returnflag", 0.5)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("l_returnflag", "part").agg(F.count("*").alias("count"))


@query
def sample_seeds(spark, sf_dir):
    points = inputs.points(spark, sf_dir)
    return _rounded(sampling.sample_seeds(points, inputs.LINE_KEY, 8, "7"), "px", "py")


# Clustering


def _fit(spark, sf_dir, steps):
    return kmeans_fit(
        spread(inputs.points(spark, sf_dir), *inputs.LINE_KEY),
        inputs.point_seeds(spark, sf_dir, SEEDS),
        steps,
        features=["px", "py"],
    )


def _assigned(spark, sf_dir):
    seeds = inputs.point_seeds(spark, sf_dir, SEEDS)
    return assign_nearest(inputs.points(spark, sf_dir), seeds, ["px", "py"])


@query
def assign_nearest_planar(spark, sf_dir):
    return _assigned(spark, sf_dir).select(*inputs.LINE_KEY, "cid")


@query
def assign_nearest_wide(spark, sf_dir):
    seeds = inputs.embedding_seeds(spark, sf_dir, 8)
    return assign_nearest(inputs.embedding_points(spark, sf_dir), seeds).select("vec_id", "cid")


@query
def assign_nearest_many(spark, sf_dir):
    """A fourth of the vectors as centroids, which stay a table past fifty."""
    points = inputs.embedding_points(spark, sf_dir)
    centroids = points.filter("vec_id % 4 = 0").select(F.col("vec_id").cast("int").alias("cid"), F.col("x").alias("c"))
    return assign_nearest(points, centroids, most_literal=50).select("vec_id", "cid")


@query
def recompute_centroids_planar(spark, sf_dir):
    means = recompute_centroids(_assigned(spark, sf_dir), ["px", "py"], 2)
    return _planar(means, "cid", "size")


@query
def recompute_centroids_wide(spark, sf_dir):
    seeds = inputs.embedding_seeds(spark, sf_dir, 8)
    assigned = assign_nearest(inputs.embedding_points(spark, sf_dir), seeds)
    means = recompute_centroids(assigned, "x", 64)
    return means.select("cid", F.posexplode("c").alias("place", "value")).select(
        "cid", "place", F.round("value", 6).alias("value")
    )


@query
def kmeans_three_steps(spark, sf_dir):
    return _planar(_fit(spark, sf_dir, 3).centroid_table(), "cid")


@query
def kmeans_fifteen_steps(spark, sf_dir):
    return _planar(_fit(spark, sf_dir, 15).centroid_table(), "cid")


@query
def kmeans_history_steps(spark, sf_dir):
    history = kmeans_history(
        inputs.points(spark, sf_dir),
        inputs.point_seeds(spark, sf_dir, SEEDS),
        15,
        features=["px", "py"],
    )
    shift = history.withColumn("shift", F.round("shift", 6))
    return _planar(shift, "iteration", "cid", "size", "shift")


@query
def bad_points(spark, sf_dir):
    """Rows that k-means leaves out: null, of another width, or not finite."""
    number = F.col("l_linenumber")
    x = (
        F.when(number == 2, F.array("px"))
        .when(number == 3, F.array(F.col("px"), F.lit(float("nan"))))
        .when(number != 1, F.array("px", "py"))
    )
    points = inputs.points(spark, sf_dir).withColumn("x", x)
    result = kmeans_fit(points, inputs.point_seeds(spark, sf_dir, SEEDS), 1)
    return result.bad_points.select(*inputs.LINE_KEY)


@query
def cluster_sizes_planar(spark, sf_dir):
    return cluster_sizes(_assigned(spark, sf_dir))


# Models


def _ratings_split(spark, sf_dir):
    pairs = models.mean_ratings(inputs.raw_ratings(spark, sf_dir))
    return sampling.split_by_hash(pairs, models.RATING_KEY, 0.8)


@query
def mean_ratings(spark, sf_dir):
    return _rounded(models.mean_ratings(inputs.raw_ratings(spark, sf_dir)), "rating")


@query
def fit_als(spark, sf_dir):
    train, _ = _ratings_split(spark, sf_dir)
    model = models.fit_als(train)
    return model.itemFactors.select(F.col("id").alias("movieId"), F.size("features").alias("rank"))


@query
def predict_ratings(spark, sf_dir):
    train, test = _ratings_split(spark, sf_dir)
    return models.predict_ratings(models.fit_als(train), test)


@query
def predicted_pairs(spark, sf_dir):
    """Which test pairs get a finite score: those whose user and item were both seen."""
    train, test = _ratings_split(spark, sf_dir)
    scored = models.predict_ratings(models.fit_als(train), test)
    score = F.col("prediction").cast("double")
    return scored.select("userId", "movieId", finite(score).alias("scored"))


@query
def compare_splits(spark, sf_dir):
    return models.compare_splits(models.mean_ratings(inputs.raw_ratings(spark, sf_dir)))


def _search(train):
    return models.tune_als(train, folds=3)


@query
def tune_als(spark, sf_dir):
    train, test = _ratings_split(spark, sf_dir)
    return models.predict_ratings(_search(train), test)


@query
def best_params(spark, sf_dir):
    train, _ = _ratings_split(spark, sf_dir)
    best = models.best_params(_search(train))
    row = (int(best["rank"]), int(best["maxIter"]), float(best["regParam"]), best["rmse"])
    return spark.createDataFrame([row], "rank int, maxIter int, regParam double, rmse double")


@query
def recommend_for_users(spark, sf_dir):
    train, _ = _ratings_split(spark, sf_dir)
    users = train.filter(F.col("userId").isin(10, 12))
    return models.recommend_for_users(models.fit_als(train), users, 12)


def _feature_split(records):
    """Training and test rows; equal records stay on one side.

    The records are stored first: the hash of a whole record names every field, and a filter on it
    would parse the line again for each.
    """
    records = materialize(records, "records")
    fitted = features.fit_features(
        records, studies.CONNECTION_CATEGORIES, studies.CONNECTION_VECTOR
    )
    columns_ = ["new_label", F.col("new_label_indexed").alias("label_indexed"), "features"]
    parts = sampling.split_by_hash(records, records.columns, 0.8, "42")
    return tuple(fitted.transform(part).select(*columns_) for part in parts)


@query
def fit_linear_svm(spark, sf_dir):
    train, test = _feature_split(_spread_records(spark, sf_dir))
    scored = models.predict(models.fit_linear_svm(train), test)
    return scored.groupBy("new_label", "prediction").agg(F.count("*").alias("count"))


@query
def predict_connections(spark, sf_dir):
    train, test = _feature_split(_spread_records(spark, sf_dir))
    scored = models.predict(models.fit_linear_svm(train), test)
    raw = vector_to_array("rawPrediction")
    return scored.select("new_label", "prediction", F.get(raw, F.lit(1)).alias("raw"))


def _comment_rows(comments):
    ready = studies.prepare_comments(comments.drop("doc_id"))
    ready = materialize(ready, "comments")
    train, test = sampling.split_exact(ready, ["CONTENT", "CLASS"])
    fitted = features.fit_tfidf(ready, "CONTENT", 5000)
    return (
        fitted.vectors(train, "CONTENT").select("CLASS", "features"),
        fitted.vectors(test, "CONTENT").select("CLASS", "features"),
    )


@query
def fit_logistic(spark, sf_dir):
    train, test = _comment_rows(inputs.comments(spark, sf_dir))
    scored = models.predict(models.fit_logistic(train, "CLASS"), test)
    return scored.select("CLASS", "prediction", vector_to_array("probability")[1].alias("share"))


@query
def fit_random_forest(spark, sf_dir):
    train, test = _comment_rows(inputs.comments(spark, sf_dir))
    model = models.fit_random_forest(train, "CLASS")
    return models.predict(model, test).select("CLASS", "prediction")


# Models on a planted signal: what they must find, as facts that SQL can state


def _learned(scored, label):
    """Rows scored, and whether the predictions beat the most frequent class by a tenth of them."""
    counts = scored.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == F.col("prediction")).alias("hits")
    )
    total = F.sum("n")
    return counts.agg(total.alias("rows"), (F.sum("hits") / total > F.max("n") / total + 0.1).alias("learned"))


@query
def split_random_parts(spark, sf_dir):
    """Both parts of a random split together: every row once."""
    rows = inputs.table(spark, sf_dir, "lineitem").select(*inputs.LINE_KEY)
    train, test = sampling.split_random(rows, [0.8, 0.2], 42)
    return train.unionByName(test).groupBy(*inputs.LINE_KEY).agg(F.count("*").alias("count"))


@query
def compare_splits_planted(spark, sf_dir):
    """Ratings that are a number of the user times one of the item; the error falls below half their spread."""
    product = (F.col("userId") % 3 + 1) * (F.col("movieId") % 2 + 1)
    pairs = models.mean_ratings(inputs.raw_ratings(spark, sf_dir))
    ratings = materialize(pairs.withColumn("rating", product.cast("double")), "ratings")
    spread_ = ratings.agg(F.stddev("rating")).first()[0]
    return models.compare_splits(ratings).select(
        "train_share", (F.col("rmse") < 0.5 * spread_).alias("learned")
    )


#: Ratings that are a number of the user times one of the item: rank 1, without noise. With hardly
#: any penalty they are found again exactly, so items fall by their number for every user.
PLANTED_FIT = {"rank": 1, "reg": 1e-4}


def _planted_ratings(spark, sf_dir):
    pairs = models.mean_ratings(inputs.raw_ratings(spark, sf_dir))
    product = (F.col("userId") % 3 + 1) * (F.col("movieId") + 20)
    return sampling.split_by_hash(pairs.withColumn("rating", product.cast("double")), models.RATING_KEY, 0.8)


@query
def fit_als_planted(spark, sf_dir):
    """The items' numbers read off their factors, which are known but for one common size."""
    train, _ = _planted_ratings(spark, sf_dir)
    factors = models.fit_als(train, **PLANTED_FIT).itemFactors
    sizes = factors.select(F.col("id").alias("movieId"), F.abs(F.get("features", F.lit(0))).cast("double").alias("size"))
    known = sizes.filter("movieId = 50").agg(F.first("size")).scalar()
    return sizes.select("movieId", F.round(F.col("size") / known * 70).cast("int").alias("number"))


@query
def predict_ratings_planted(spark, sf_dir):
    train, test = _planted_ratings(spark, sf_dir)
    scored = models.predict_ratings(models.fit_als(train, **PLANTED_FIT), test)
    return scored.select("userId", "movieId", F.round("prediction").cast("int").alias("prediction"))


@query
def recommend_for_users_planted(spark, sf_dir):
    train, _ = _planted_ratings(spark, sf_dir)
    lists = models.recommend_for_users(models.fit_als(train, **PLANTED_FIT), train, 12)
    return lists.select("userId", "rank", "movieId", F.round("score").cast("int").alias("score"))


def _planted_search(spark, sf_dir):
    """Ratings of rank 2: even users count one way, odd ones the other."""
    pairs = models.mean_ratings(inputs.raw_ratings(spark, sf_dir))
    step = F.col("movieId") % 5
    rating = F.when(F.col("userId") % 2 == 0, step + 1).otherwise(6 - step).cast("double")
    train, _ = sampling.split_by_hash(pairs.withColumn("rating", rating), models.RATING_KEY, 0.8)
    return models.tune_als(train, {"rank": [1, 2], "maxIter": [10], "regParam": [0.01, 1.0]}, folds=3)


@query
def tune_als_planted(spark, sf_dir):
    """The setting of the true rank and a small penalty is best, that with neither is worst."""
    table = models.search_table(_planted_search(spark, sf_dir))
    place = F.when(F.col("place").isin(1, 4), F.col("place")).otherwise(2)
    return table.select("rank", "maxIter", "regParam", place.cast("int").alias("place"))


@query
def best_params_planted(spark, sf_dir):
    best = models.best_params(_planted_search(spark, sf_dir))
    row = (int(best["rank"]), int(best["maxIter"]), float(best["regParam"]))
    return spark.createDataFrame([row], "rank int, maxIter int, regParam double")


@query
def predict_connections_planted(spark, sf_dir):
    """A label that follows from one numeric field."""
    label = F.when(F.col("dst_bytes") > 25, "attack").otherwise("normal")
    train, test = _feature_split(_spread_records(spark, sf_dir).withColumn("new_label", label))
    scored = models.predict(models.fit_linear_svm(train), test)
    return _learned(scored, "label_indexed")


def _planted_comments(spark, sf_dir):
    """Comments whose class says whether they hold a common word."""
    word = F.col("CONTENT").contains(" the ").cast("double")
    return inputs.comments(spark, sf_dir).withColumn("CLASS", word)


@query
def fit_logistic_planted(spark, sf_dir):
    train, test = _comment_rows(_planted_comments(spark, sf_dir))
    return _learned(models.predict(models.fit_logistic(train, "CLASS"), test), "CLASS")


@query
def fit_random_forest_planted(spark, sf_dir):
    train, test = _comment_rows(_planted_comments(spark, sf_dir))
    return _learned(models.predict(models.fit_random_forest(train, "CLASS"), test), "CLASS")


# Evaluation


@query
def rmse(spark, sf_dir):
    return _rounded(evaluation.rmse(inputs.scored_pairs(spark, sf_dir)), "rmse")


@query
def mae(spark, sf_dir):
    return _rounded(evaluation.mae(inputs.scored_pairs(spark, sf_dir)), "mae")


@query
def accuracy(spark, sf_dir):
    return _rounded(evaluation.accuracy(inputs.scored_pairs(spark, sf_dir)), "accuracy")


@query
def f1_weighted(spark, sf_dir):
    return _rounded(evaluation.f1_weighted(inputs.scored_pairs(spark, sf_dir)), "f1")


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(inputs.scored_pairs(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    report = evaluation.classification_report(inputs.scored_pairs(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def compare_models(spark, sf_dir):
    scored = {
        "thirds": inputs.scored_pairs(spark, sf_dir, 3),
        "fifths": inputs.scored_pairs(spark, sf_dir, 5),
    }
    return _rounded(evaluation.compare_models(scored), "value")


def _raw_records(spark, sf_dir):
    return read_positional(inputs.connection_lines(spark, sf_dir), inputs.CONNECTION_FIELDS)


def _spread_records(spark, sf_dir):
    lines = spread(inputs.connection_lines(spark, sf_dir))
    return studies.read_connections(lines, inputs.CONNECTION_FIELDS)


def _records(spark, sf_dir):
    lines = inputs.connection_lines(spark, sf_dir)
    return studies.read_connections(lines, inputs.CONNECTION_FIELDS)
