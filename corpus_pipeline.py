"""A training-data pipeline over ``documents``: five stages, each stored before the next reads it.

Language identification drops texts of no known language; SimHash keeps one document of each group
of near copies; secret scans mask what they find; the mix takes each source's share; packing lays
the documents out in sequences of tokens. All stages but the last return the columns of their
input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import language_id, mixing, packing, secrets, simhash
from tallywright.llm.text_units import spare_name, words_of
from tallywright.session import materialize

#: Least cosine with any language: the spread of the cosine of unrelated vectors. A text below it
#: resembles none; a single ordinary word is above.
LEAST_COSINE = language_id.DIMENSIONS**-0.5
#: Share of the tokens that the mix takes, with languages weighted within each source group.
MIX_SHARE, MIX_SEED = 0.9, 5
MIX_WEIGHTS = {("all", "en"): 6, ("all", "fr"): 2, ("all", "de"): 2, ("all", "es"): 1}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted language is known; those without letters or like no language go.

    Learned from the documents that are not held out. A table without any labelled text teaches
    nothing, and then every document with a letter stays.
    """
    languages = language_id.learn(docs.filter(~language_id.is_held_out()).select("text", "lang"))
    if not languages:
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    # only the text goes in: what the operator adds cannot meet a column of the documents
    own, found = spare_name(docs, "text"), spare_name(docs, "found")
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(found), F.col("text").alias(own))
    named = language_id.identify(given, languages, text=own)
    kept = named.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_COSINE))
    return kept.select(f"{found}.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash group.

    Of several rows with one id that smallest document has, the one whose columns are least stays;
    rows without an id stay as they are.
    """
    groups = simhash.cluster(docs.select("doc_id", "text"))
    keep = groups.filter("doc_id = component_id").select("doc_id").distinct()
    own = docs.filter("doc_id is not null").join(keep, "doc_id", "left_semi")
    row = spare_name(docs, "row")
    single = own.groupBy("doc_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row))
    return single.select(f"{row}.*").unionByName(docs.filter("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and ``n_chars`` kept true to the text."""
    found, own = spare_name(docs, "found"), spare_name(docs, "text")
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(found), F.col("text").alias(own))
    scanned = secrets.scan_secrets(given, text=own)
    hit = F.size("secret_spans") > 0
    masked = F.when(hit, secrets.redact(F.col(own), F.col("secret_spans"))).otherwise(F.col(own))
    changed = {"text": masked}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.length(masked).cast(kind)).otherwise(F.col(f"{found}.n_chars"))
    return scanned.select(*[changed.get(c, F.col(f"{found}.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The share of each language and source that the weights ask for, each document once at most."""
    domain = F.lit("all")
    rows = mixing.slim(docs, "doc_id", domain, F.size(words_of(F.col("text"))))
    mix = mixing.plan_mix(rows, MIX_WEIGHTS, share=MIX_SHARE, max_epochs=1, seed=MIX_SEED)
    return mixing.take(docs, mix, domain).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, its tokens' place in it, and its place in a sequence."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Fingerprints, learned languages and token ids are no SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each stage's result stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
