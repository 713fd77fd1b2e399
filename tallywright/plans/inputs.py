"""The job inputs in their expected shapes, derived from the given parquet tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.plans.studies import CONNECTION_ORDINALS
from tallywright.sources import spread

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
#: Lines of a rating file that are well formed, from its start.
CLEAN_LINES = 500
CONNECTION_FIELDS = {**CONNECTION_ORDINALS, "label": 6}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``; every use of the texts is heavy enough to deserve all task slots."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: one document per row."""
    return documents(spark, sf_dir).select(F.col("text").alias("value"))


def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: integers written as text."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("value"))


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: a department and a salary with one blank between."""
    return table(spark, sf_dir, "customer").select(
        F.concat_ws(" ", "c_mktsegment", F.col("c_acctbal").cast("string")).alias("value")
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-d points with their row key."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, F.col("l_quantity").alias("px"), (F.col("l_extendedprice") / 1000).alias("py")
    )


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2-d points as ``px,py`` text, with their row key."""
    text = F.concat_ws(",", F.col("px").cast("string"), F.col("py").cast("string"))
    return points(spark, sf_dir).select(*LINE_KEY, text.alias("value"))


def point_seeds(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The first k points in key order as centroids 0..k-1."""
    first = points(spark, sf_dir).orderBy(*LINE_KEY).limit(k).collect()
    rows = [(cid, [row.px, row.py]) for cid, row in enumerate(first)]
    return spark.createDataFrame(rows, "cid int, c array<double>")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-d points ``(vec_id, x)``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x")
    )


def embedding_seeds(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The k lowest ids as centroids 0..k-1."""
    first = embedding_points(spark, sf_dir).orderBy("vec_id").limit(k).collect()
    rows = [(cid, list(row.x)) for cid, row in enumerate(first)]
    return spark.createDataFrame(rows, "cid int, c array<double>")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId, movieId, rating)`` on a 1 to 5 scale, repeats included."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("movieId"),
        F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.round(F.col("value") / 10 + 1))).alias(
            "rating"
        ),
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headered CSV of ratings in the order of events; after the first lines some are malformed."""
    number = F.col("event_id")
    rating = F.round(F.col("value") / 10 + 1).cast("string")
    fields = ["userId", "movieId", "rating"]
    user, item = F.col("user_id").cast("string"), F.get_json_object("props", "$.k")
    kind = F.when(number >= CLEAN_LINES, number % 50)
    line = (
        F.when(kind == 0, F.concat_ws(",", user, F.lit("n/a"), rating))
        .when(kind == 1, F.concat_ws(",", user, item))
        .when(kind == 2, F.concat_ws(",", user, item, rating, F.lit("more")))
        .otherwise(F.concat_ws(",", user, item, rating))
    )
    lines = table(spark, sf_dir, "events").select(number.alias("number"), line.alias("value"))
    header = spark.range(1).select(F.lit(-1).cast("bigint").alias("number"), F.lit(",".join(fields)).alias("value"))
    return header.union(lines).orderBy("number").select("value")


def connection_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-less comma-separated connection records."""
    label = (
        F.when(F.col("l_quantity") > 40, "bulk.")
        .when(F.col("l_discount") > 0.08, "promo.")
        .otherwise("normal.")
    )
    service = F.concat(F.lit("s"), (F.col("l_suppkey") % 20).cast("string"))
    text = F.concat_ws(
        ",",
        F.col("l_discount").cast("string"),
        "l_returnflag",
        service,
        "l_linestatus",
        F.col("l_extendedprice").cast("string"),
        F.col("l_quantity").cast("string"),
        label,
    )
    return table(spark, sf_dir, "lineitem").select(text.alias("value"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, CONTENT)``, for what needs no class."""
    return documents(spark, sf_dir).withColumnRenamed("text", "CONTENT")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, CONTENT, CLASS, DATE, Column6)``; most rows have no class."""
    texts = documents(spark, sf_dir).withColumnRenamed("text", "CONTENT")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").cast("double").alias("CLASS")
    )
    return texts.join(labels, "doc_id", "left").select(
        "*",
        F.lit(None).cast("string").alias("DATE"),
        F.lit(None).cast("string").alias("Column6"),
    )


def scored_pairs(spark: SparkSession, sf_dir: str, modulus: int = 3) -> DataFrame:
    """Deterministic ``(label, prediction)`` pairs for the metrics."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    guess = F.when(F.col("n_chars") % modulus == 0, 1).otherwise(0)
    return labels.join(documents, "doc_id").select("label", guess.alias("prediction"))
