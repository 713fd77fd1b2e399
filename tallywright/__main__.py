"""Command line: ``spark-submit`` or ``python -m tallywright <job> ...``; results are directories."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators.columns import field_count
from tallywright.plans import studies
from tallywright.session import discard_stored
from tallywright.sources import read_lines, read_table_csv


def write_tables(tables: dict[str, DataFrame], target: str) -> None:
    """Each result as a parquet directory below ``target``; an existing one is an error."""
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{target}/{name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallywright", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=text)
        added.add_argument("source")
        added.add_argument("target")
        return added

    job("lines", "number of lines")
    kmeans = job("kmeans", "k-means from given seeds; centroids per iteration in <target>_<i>")
    kmeans.add_argument("seeds")
    kmeans.add_argument("k", type=int)
    kmeans.add_argument("--iterations", type=int, default=15)
    seeds = job("seeds", "draw k lines of a point file")
    seeds.add_argument("k", type=int)
    seeds.add_argument("--seed", default="0")
    job("parity", "even and odd integers")
    job("salaries", "salary sum per department")
    words = job("words", "listed, most and least frequent words")
    words.add_argument("--words", nargs="+", default=studies.SELECTED_WORDS)
    words.add_argument("--top", type=int, default=15)
    ratings = job("ratings", "averages, recommender, grid search and recommendations")
    ratings.add_argument("--users", type=int, nargs="+", default=[10, 12])
    ratings.add_argument("--schema", default="userId int, movieId int, rating double")
    connections = job("connections", "counts and a linear SVM over connection records")
    connections.add_argument("--label", type=int, help="position of the label field")
    connections.add_argument("--partitions", type=int, help="spread unsplittable input")
    comments = job("comments", "profile and classify labelled comments")
    comments.add_argument("--trees", type=int, default=100)
    comments.add_argument("--depth", type=int, default=10)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    source, target = args.source, args.target
    if args.job == "lines":
        studies.count_lines(spark, source, target)
    elif args.job == "kmeans":
        result = studies.cluster_points(spark, source, target, args.seeds, args.k, args.iterations)
        for iteration, spent in enumerate(result.milliseconds):
            print(f"iteration {iteration}: {spent} ms")
    elif args.job == "seeds":
        studies.pick_seeds(spark, source, target, args.k, args.seed)
    elif args.job == "parity":
        write_tables({"parity": studies.count_parity(spark, source)}, target)
    elif args.job == "salaries":
        write_tables({"salaries": studies.sum_salaries(spark, source)}, target)
    elif args.job == "words":
        counts = f"{target}/counts"
        write_tables(studies.study_words(spark, source, counts, args.words, args.top), target)
    elif args.job == "ratings":
        ratings = read_table_csv(spark, source, args.schema)
        write_tables(studies.study_ratings(ratings, args.users), target)
    elif args.job == "connections":
        lines = read_lines(spark, source, args.partitions)
        places = dict(studies.CONNECTION_ORDINALS)
        if args.label is not None:
            places["label"] = args.label
        studies.read_connections(lines, places).write.parquet(f"{target}/records")
        records = spark.read.parquet(f"{target}/records")
        write_tables({"fields": field_count(lines)}, target)
        write_tables(studies.study_connections(records), target)
    elif args.job == "comments":
        comments = read_table_csv(spark, source, multi_line=True)
        comments = comments.withColumn("CLASS", comments.CLASS.try_cast("double"))
        write_tables(studies.profile_comments(comments), f"{target}/profile")
        key = [name for name in comments.columns if name not in {"DATE", "Column6"}]
        results = studies.classify_comments(comments, key, trees=args.trees, depth=args.depth)
        write_tables(results, f"{target}/models")


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"tallywright {args.job}").getOrCreate()
    try:
        run(spark, args)
        discard_stored(spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
