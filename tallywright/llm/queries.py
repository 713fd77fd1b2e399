"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallywright.llm import (
    divergence, hard_negatives, html_main, language_id, licenses, mixing, neighbours, packing, quality, secrets, sharding,
    simhash, substrings,
)
from tallywright.llm.text_units import words_of

#: Production parameters of the queries whose contract leaves them free.
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))
NEIGHBOURS = 20
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 11
MIX_WEIGHTS = {
    ("web",): 4, ("books",): 3, ("forum",): 2, ("news",): 1,
    **{(d, lang): w for d in ("web", "books", "forum", "news") for lang, w in (("en", 5), ("fr", 2), ("de", 2), ("es", 1))},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: Column) -> Column:
    """A domain for each source of the tables: the hot source alone is the web, the others are dealt by number."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1).try_cast("int")
    return (
        F.when(number == 0, "web").when(number % 3 == 1, "books").when(number % 3 == 2, "forum").otherwise("news")
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages = language_id.learn(docs.filter(~language_id.is_held_out()).select("text", "lang"))
    named = docs.select("doc_id", language_id.is_held_out().alias("held_out"), "text")
    return language_id.identify(named, languages).select("doc_id", "held_out", "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.cluster(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_mark(F.col("mark")).alias("fingerprint"), "component_id")


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_main.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.place(docs, ["doc_id"], SHARDS)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors.filter(F.col("vec_id") % 20 == 0), vectors, NEIGHBOURS)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = mixing.slim(docs, "doc_id", domain_of(F.col("source")), F.size(words_of(F.col("text"))))
    mix = mixing.plan_mix(rows, MIX_WEIGHTS, share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    taken = mixing.take(rows, mix, F.col("domain"))
    return taken.select("doc_id", "epoch", "domain", "lang", "source", "tokens")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("intervals", F.lit(0).cast("long"), lambda n, span: n + (span["end"] - span["start"]))
    return cut.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_html_main_text": op3_html_main_text,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_sharding": op5_sharding,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_source_mix": op7_source_mix,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_secret_scans": op10_secret_scans,
    "op11_license_scans": op11_license_scans,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
