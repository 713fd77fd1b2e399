"""How far the sources of a language differ in their words: smoothed shares, exact in whole numbers.

Tasks count the terms of their texts (:mod:`packed_terms`) and hand on one row for each language,
source and term; Spark adds them up. The terms that enough documents of a language hold are its
vocabulary. Every source and the language as a whole give each of them a share in billionths,
smoothed so that none is without. Sources are compared over blocks of the vocabulary, so a block
holds a bounded number of terms however many documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.packed_terms import count_terms
from tallywright.session import materialize

#: Documents of a language that must hold a term, occurrences added to each, and shares in a whole.
LEAST_DOCUMENTS, SMOOTHING, WHOLE = 30, 5, 1_000_000_000
#: Ranks of the report of terms.
TERM_RANKS = 50
#: Bytes of text counted at once, terms of a block, and parts that a group's rows are dealt into.
CHUNK_BYTES, BLOCK_TERMS, SALTS = 8 << 20, 2_000, 16
#: Shares compared at once, of all sources together.
COMPARED = 1 << 21

COUNTS = "lang string, source string, term string, n long, documents long"


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Rows (lang, source, term, n, documents): occurrences, and documents with the term.

    Nulls count as ''. Every group that occurs has a row with the term '' and no occurrences.
    """
    asked = docs.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))],
        F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "utf-8").alias("text"),
    )

    def counted(waiting: list[tuple[str, str]], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        names = sorted(set(waiting))
        number = {name: k for k, name in enumerate(names)}
        groups = np.array([number[w] for w in waiting], dtype=np.int64)
        parts = [(np.arange(len(names)), [b""] * len(names), np.zeros(len(names), np.int64), np.zeros(len(names), np.int64))]
        parts += count_terms(texts, groups)
        langs, sources = (pa.array([name[k] for name in names], pa.string()) for k in range(2))
        for group, terms, n, seen in parts:
            own = pa.array(group)
            yield pa.record_batch(
                [langs.take(own), sources.take(own), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(seen, pa.int64())],
                ["lang", "source", "term", "n", "documents"],
            )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, texts, size = [], [], 0
        for batch in batches:
            for name, other, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                waiting.append((name.as_py(), other.as_py()))
                texts.append(text.as_py())
                size += len(texts[-1])
                if size > CHUNK_BYTES:
                    yield from counted(waiting, texts)
                    waiting, texts, size = [], [], 0
        if waiting:
            yield from counted(waiting, texts)

    return (
        asked.mapInArrow(task, COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (n + SMOOTHING) / (total + SMOOTHING * terms)), in decimals of 38 digits."""
    above = (n.cast("decimal(20,0)") + SMOOTHING) * F.lit(WHOLE).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * SMOOTHING
    return F.call_function("div", above, below) + 1


def block_distances(rows: pa.Table, sources: pa.Table) -> pa.Table:
    """Summed differences of each pair of sources over the terms of one block.

    ``rows`` holds the shares ``p`` of the terms that occur; ``sources`` gives, for every source of
    the language, the share of a term that it does not have.
    """
    names = sources["source"].to_pylist()
    number = {name: k for k, name in enumerate(names)}
    absent = np.array(sources["absent"].to_pylist(), dtype=np.int64)
    terms = rows["term"].dictionary_encode().combine_chunks() if rows.num_rows else None
    count = len(terms.dictionary) if terms is not None else 0
    total = np.zeros((len(names), len(names)), dtype=np.int64)
    if count:
        place = terms.indices.to_numpy()
        own = np.array([number[s] for s in rows["source"].to_pylist()])
        given = rows["p"].to_numpy()
        order = np.argsort(place, kind="stable")
        place, own, given = place[order], own[order], given[order]
        step = max(1, COMPARED // len(names))
        for low in range(0, count, step):
            a, b = np.searchsorted(place, [low, low + step])
            shares = np.broadcast_to(absent, (min(step, count - low), len(names))).copy()
            shares[place[a:b] - low, own[a:b]] = given[a:b]
            for k in range(len(names) - 1):
                total[k, k + 1 :] += np.abs(shares[:, k + 1 :] - shares[:, k : k + 1]).sum(axis=0)
    left, right = np.triu_indices(len(names), 1)
    column = pa.array(names, pa.string())
    langs = pa.array([sources["lang"][0].as_py()] * len(left) if len(names) else [], pa.string())
    return pa.table(
        [langs, column.take(pa.array(left)), column.take(pa.array(right)), pa.array(total[left, right])],
        names=["lang", "one", "other", "value"],
    )


def audit_sources(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least: int = LEAST_DOCUMENTS, term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every group of language and source.

    Part ``pair``: each other source of the language, by falling summed difference of the shares of
    all the language's terms, which is 0 without any. Part ``term``: the terms of the group whose
    share is above the language's, by falling difference, up to ``term_ranks``. Ties go to the item
    that is smaller in UTF-8. Null text, language and source count as ''; every row is a document,
    repeated or not; empty texts still make their group occur; an empty table has no rows. The
    pairs of a language are as many as the square of its sources, as the report asks for each;
    each block of terms adds that many rows before they are summed.
    """
    counts = materialize(term_counts(docs, lang, source, text), "term-counts")
    groups = counts.filter("term = ''").select("lang", "source")
    kept = (
        counts.filter("term != ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("whole_n"), F.sum("documents").alias("documents"))
        .filter(F.col("documents") >= least)
        .select("lang", "term", "whole_n")
    )
    kept = materialize(kept, "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("whole_n").alias("whole"))
    used = materialize(
        counts.filter("term != ''").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole_n"),
        "used-terms",
    )
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    sized = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    sized = materialize(
        sized.select(
            "lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("terms", "whole", "total")]
        ),
        "groups",
    )
    # a group's rows are dealt into parts, so that a large one is not read by one task
    salted = sized.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = used.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    blocks = F.greatest(F.ceil(F.col("terms") / BLOCK_TERMS), F.lit(1))
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("whole_n"), F.col("whole"), F.col("terms"))
    shares = materialize(
        dealt.join(salted, ["lang", "source", "salt"]).select(
            "lang", "source", "term", p.alias("p"), q.alias("q"), F.pmod(F.xxhash64("term", F.lit(1)), blocks).alias("block")
        ),
        "shares",
    )
    absent = F.when(F.col("terms") > 0, share(zero, F.col("total"), F.col("terms"))).otherwise(zero)
    listed = sized.select(
        "lang", "source", absent.alias("absent"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")
    )
    summed = (
        shares.select("lang", "block", "source", "term", "p")
        .groupBy("lang", "block")
        .cogroup(listed.groupBy("lang", "block"))
        .applyInArrow(block_distances, "lang string, one string, other string, value long")
        .groupBy("lang", "one", "other")
        .agg(F.sum("value").alias("value"))
    )
    sides = F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item")),
    )
    pairs = summed.select("lang", F.inline(sides), "value").select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    above = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    terms = above.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= term_ranks)
    return ranked.unionByName(terms)
