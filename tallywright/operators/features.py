"""TF-IDF, category indexes and feature vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywright.functions import text as T
from tallywright.functions.naming import spare_name
from tallywright.operators.joins import HOT_KEYS, lookup
from tallywright.operators.numbering import with_place
from tallywright.session import materialize, shared_path

#: Terms up to which a vocabulary is broadcast; a larger one stays a table.
BROADCAST_TERMS = 100_000


@dataclass
class TfidfModel:
    """A fitted vocabulary, most frequent term first, with its smoothed idf weights.

    The weight of a term is ``tf * (ln((1 + n) / (1 + df)) + 1)``, scaled to unit length per row.
    """

    spark: SparkSession
    terms: list[str]
    idf: list[float]
    rows: int

    def term_table(self) -> DataFrame:
        """``(place, term)``, one row per term."""
        return self.spark.createDataFrame(list(enumerate(self.terms)), "place int, term string")

    def vectors(self, df: DataFrame, column: str, out: str = "features") -> DataFrame:
        """Add the sparse weight vector. Row-local: the vocabulary is broadcast, nothing shuffles."""
        if not self.terms:
            raise ValueError("the vocabulary is empty")
        counter = CountVectorizerModel.from_vocabulary(
            self.terms, inputCol="__terms", outputCol="__counts"
        )
        weigh = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="__counts", outputCol="__weights"
        )
        scale = Normalizer(p=2.0, inputCol="__weights", outputCol=out)
        counted = counter.transform(df.withColumn("__terms", T.terms(column)))
        return scale.transform(weigh.transform(counted)).drop("__terms", "__counts", "__weights")

    def long(self, df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
        """``(keep..., term, weight)``, one row per document and vocabulary term in it."""
        vector = F.unwrap_udt("__features")
        entries = F.explode(F.arrays_zip(vector["indices"].alias("i"), vector["values"].alias("w")))
        weights = (
            self.vectors(df, column, "__features")
            .select(*keep, entries.alias("entry"))
            .select(*keep, F.col("entry.i").alias("__place"), F.col("entry.w").alias("weight"))
        )
        # At most BROADCAST_TERMS rows, checked when the vocabulary was fitted.
        names = self.term_table().withColumnRenamed("place", "__place")
        return weights.join(F.broadcast(names), "__place").select(*keep, "term", "weight")


@dataclass
class TfidfTable:
    """A fitted vocabulary of any size, kept as a table; the same weights as :class:`TfidfModel`.

    ``vocabulary`` has ``(place, term, documents, idf)``. Every row's terms are counted within the
    row, meet the vocabulary by a join that neither gathers a hot term's rows nor broadcasts more
    than ``hot_terms`` terms, and come together again by row. The rows are stored once, as their
    numbers must not change on the way.
    """

    vocabulary: DataFrame
    size: int
    rows: int
    hot_terms: int = HOT_KEYS

    def term_table(self) -> DataFrame:
        return self.vocabulary.select("place", "term")

    def _weighed(self, stored: DataFrame, row: str, keep: Sequence[str] = ()) -> DataFrame:
        """``(row, keep..., __raw)``: entries (place, term, weight) in the order of places, not yet scaled."""
        counts = stored.select(row, *keep, F.inline("__counts"))
        met = lookup(counts, self.vocabulary, "term", ["place", "idf"], "documents", self.hot_terms)
        raw = met.filter(F.col("place").isNotNull()).select(
            row, *keep, F.struct("place", "term", (F.col("tf") * F.col("idf")).alias("weight")).alias("__entry")
        )
        # no more entries than the row has terms
        return raw.groupBy(row, *keep).agg(F.sort_array(F.collect_list("__entry")).alias("__raw"))

    def long(self, df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
        """``(keep..., term, weight)``, one row per document and vocabulary term in it."""
        row = spare_name(df, "row")
        stored = materialize(_counted(df, column, keep, row), "term-counts")
        scaled = _scaled(F.col("__raw"), lambda e, weight: F.struct(e["term"].alias("term"), weight.alias("weight")))
        return self._weighed(stored, row, keep).select(*keep, F.inline(scaled)).select(*keep, "term", "weight")

    def vectors(self, df: DataFrame, column: str, out: str = "features") -> DataFrame:
        """Add the sparse weight vector; rows without a vocabulary term get an empty one."""
        if not self.size:
            raise ValueError("the vocabulary is empty")
        row = spare_name(df, "row")
        kept = [name for name in df.columns if name != out]
        stored = materialize(_counted(df, column, df.columns, row), "term-counts")
        joined = stored.join(self._weighed(stored, row), row, "left")
        entries = F.coalesce("__raw", F.array().cast("array<struct<place:int,term:string,weight:double>>"))
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.size).alias("size"),
            F.transform(entries, lambda e: e["place"]).alias("indices"),
            _scaled(entries, lambda _, weight: weight).alias("values"),
        )
        # a vector column is stored as these four fields, so it can be read back as one
        path = shared_path(df.sparkSession, "vectors")
        rows = joined.select(*[F.col(f"`{c}`") for c in kept], vector.alias(out))
        rows.write.parquet(path, compression="zstd")
        schema = StructType([*[df.schema[c] for c in kept]]).add(out, VectorUDT())
        return df.sparkSession.read.schema(schema).parquet(path)


def _scaled(entries: Column, value: Callable[[Column, Column], Column]) -> Column:
    """The value of every entry and its weight at unit length, squares added up in the order of places.

    The norm is a lambda's argument, which is computed once for a row. A column for it would be merged
    into the lambda that divides by it, and computed once for each entry.
    """
    squares = F.aggregate(entries, F.lit(0.0), lambda total, e: total + e["weight"] * e["weight"])
    scaled = F.transform(
        F.array(F.sqrt(squares)), lambda norm: F.transform(entries, lambda e: value(e, e["weight"] / norm))
    )
    return F.get(scaled, F.lit(0))


def _counted(df: DataFrame, column: str, keep: Sequence[str], row: str) -> DataFrame:
    """The kept columns, a row number, and ``__counts``: (term, tf) of the row's distinct terms."""
    kept = [F.col(f"`{c}`") for c in keep]
    words = df.select(*kept, F.sort_array(T.terms(column)).alias("__words"))
    # sorted terms are counted by where the next one starts
    starts = F.filter(
        F.transform("__words", lambda w, i: F.when((i == 0) | (w != F.get("__words", i - 1)), i)), lambda i: i.isNotNull()
    )
    split = words.withColumn("__starts", starts)
    counts = F.transform(
        "__starts",
        lambda at, k: F.struct(
            F.get("__words", at).alias("term"),
            (F.coalesce(F.get("__starts", k + 1), F.size("__words")) - at).alias("tf"),
        ),
    )
    return split.select(*kept, counts.alias("__counts"), F.monotonically_increasing_id().alias(row))


def fit_tfidf(
    df: DataFrame,
    column: str,
    max_features: int | None,
    stop_words: str | Sequence[str] | None = None,
    broadcast_terms: int = BROADCAST_TERMS,
    hot_terms: int = HOT_KEYS,
) -> TfidfModel | TfidfTable:
    """Fit the ``max_features`` most frequent terms, ties in term order, and their idf; None takes all.

    One scan gives corpus counts, document counts and the number of rows: every row emits its
    terms, its distinct terms and one marker. They are combined on the map side and shuffled by
    term. Up to ``broadcast_terms`` terms reach the driver and make a model that works row by row;
    a larger vocabulary is ranked and stored as a table. To keep test rows out of the vocabulary,
    fit on the training rows.
    """
    if max_features is not None and max_features < 1:
        raise ValueError("max_features from 1, or None")
    terms = F.col("__terms")
    # Three lists per row: a marker, every term, every distinct term.
    lists = F.array(F.array(F.lit(None).cast("string")), terms, F.array_distinct(terms))
    rows = (
        df.select(T.terms(column).alias("__terms"))
        .select(F.posexplode(lists).alias("kind", "words"))
        .select("kind", F.explode("words").alias("term"))
        .filter(F.col("term").isNull() | T.not_stop_word("term", stop_words))
    )
    counts = rows.groupBy("term").agg(
        F.count_if(F.col("kind") == 1).alias("seen"),
        F.count_if(F.col("kind") != 1).alias("documents"),
    )
    if max_features is None or max_features > broadcast_terms:
        return _vocabulary_table(counts, max_features, hot_terms)
    # The marker row sorts first, so it rides along with the report.
    top = counts.orderBy(F.col("term").isNotNull(), F.desc("seen"), "term").limit(max_features + 1)
    fitted = top.collect()
    total = next((row.documents for row in fitted if row.term is None), 0)
    vocabulary = [row for row in fitted if row.term is not None]
    idf = [math.log((1 + total) / (1 + row.documents)) + 1 for row in vocabulary]
    return TfidfModel(df.sparkSession, [row.term for row in vocabulary], idf, total)


def _vocabulary_table(counts: DataFrame, max_features: int | None, hot_terms: int) -> TfidfTable:
    stored = materialize(counts, "terms")
    marker = stored.filter(F.col("term").isNull()).first()
    total = marker["documents"] if marker else 0
    placed = with_place(stored.filter(F.col("term").isNotNull()), [F.desc("seen"), "term"], "place")
    if max_features is not None:
        placed = placed.filter(F.col("place") < max_features)
    idf = F.log((1 + F.lit(total)) / (1 + F.col("documents"))) + 1
    vocabulary = materialize(
        placed.select(F.col("place").cast("int").alias("place"), "term", "documents", idf.alias("idf")), "vocabulary"
    )
    return TfidfTable(vocabulary, vocabulary.count(), total, hot_terms)


def tfidf_long(
    df: DataFrame,
    column: str,
    keep: Sequence[str],
    max_features: int | None,
    stop_words: str | Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
    **fit: int,
) -> DataFrame:
    """Term weights in long form. By default fitted on the same rows; ``fit`` goes to the fitting."""
    model = fit_tfidf(df if fit_on is None else fit_on, column, max_features, stop_words, **fit)
    return model.long(df, column, keep)


def tfidf_vectors(
    df: DataFrame,
    column: str,
    max_features: int | None = 5000,
    stop_words: str | Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
    out: str = "features",
    **fit: int,
) -> DataFrame:
    """Term weights as a sparse vector column."""
    model = fit_tfidf(df if fit_on is None else fit_on, column, max_features, stop_words, **fit)
    return model.vectors(df, column, out)


def mean_tfidf_by_class(
    df: DataFrame,
    column: str,
    label: str,
    value: object,
    n: int = 10,
    max_features: int | None = 100,
    stop_words: str | Sequence[str] | None = "english",
    **fit: int,
) -> DataFrame:
    """Mean weight per term over all rows of a class, rows without the term counting as zero.

    The vocabulary comes from all rows, so a term unknown to the class scores zero; weights are
    computed for rows of the class alone. Ties in descending term order.
    """
    model = fit_tfidf(df, column, max_features, stop_words, **fit)
    members = df.filter(F.col(label) == F.lit(value))
    # this count reads the label column alone
    size = members.agg(F.count("*").cast("double").alias("size")).scalar()
    sums = model.long(members, column, [label]).groupBy("term").agg(F.sum("weight").alias("total"))
    means = model.term_table().join(sums, "term", "left").select(
        "term", F.try_divide(F.coalesce("total", F.lit(0.0)), size).alias("score")
    )
    return means.orderBy(F.desc("score"), F.desc("term")).limit(n)


@dataclass
class CategoryIndex:
    """Places of the categories of some columns: by falling frequency, ties alphabetical.

    ``table`` has ``(column, category, place, rows)``, the column by its number; ``sizes`` the
    number of categories of each. Any number of categories is allowed; only the frequent ones, or
    all of a column that has no more than ``hot_keys``, are broadcast.
    """

    table: DataFrame
    sizes: dict[str, int]
    suffix: str = "_indexed"
    unseen: str = "error"
    hot_keys: int = HOT_KEYS

    def transform(self, df: DataFrame) -> DataFrame:
        """Add one index column for each column.

        A null or unknown category is an error with ``unseen='error'``; ``skip`` leaves its rows
        out and ``keep`` gives it the place after the last one.
        """
        for number, (name, size) in enumerate(self.sizes.items()):
            key, place, weight = (spare_name(df, stem) for stem in ("category", "place", "rows"))
            own = self.table.filter(F.col("column") == number).select(
                F.col("category").alias(key), F.col("place").alias(place), F.col("rows").alias(weight)
            )
            keyed = df.withColumn(key, F.col(f"`{name}`").cast("string"))
            found = lookup(keyed, own, key, [place], weight, self.hot_keys)
            if self.unseen == "skip":
                found = found.filter(F.col(place).isNotNull())
            found = found.withColumn(name + self.suffix, self._checked(name, F.col(place), F.col(key), size)).drop(key, place)
            # a column joined by shuffle reads its rows twice, the next one must not double that
            df = materialize(found, "indexed") if size > self.hot_keys and number + 1 < len(self.sizes) else found
        return df

    def _checked(self, name: str, place: Column, category: Column, size: int) -> Column:
        if self.unseen == "keep":
            return F.coalesce(place, F.lit(float(size)))
        message = F.concat(F.lit(f"column {name} has no place for the category "), F.coalesce(category, F.lit("null")))
        return F.when(place.isNull(), F.raise_error(message)).otherwise(place) if self.unseen == "error" else place


def fit_category_index(
    df: DataFrame, columns: Sequence[str], suffix: str = "_indexed", unseen: str = "error", hot_keys: int = HOT_KEYS
) -> CategoryIndex:
    """Index categories by falling frequency, ties alphabetical; one pass for all columns.

    Counts are combined before their shuffle, ranked without a task that sees them all, and stored.
    """
    if unseen not in {"error", "skip", "keep"}:
        raise ValueError("unseen must be 'error', 'skip' or 'keep'")
    cells = F.array(
        *[
            F.struct(F.lit(number).alias("column"), F.col(f"`{name}`").cast("string").alias("category"))
            for number, name in enumerate(columns)
        ]
    )
    counts = (
        df.select(F.inline(cells))
        .filter(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    ranked = with_place(counts, ["column", F.desc("rows"), "category"], "place")
    # one row for each column
    firsts = ranked.groupBy("column").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    table = materialize(
        ranked.join(F.broadcast(firsts), "column").select(
            "column", "category", (F.col("place") - F.col("first")).cast("double").alias("place"), "rows"
        ),
        "categories",
    )
    sizes = {row["column"]: row["size"] for row in firsts.collect()}
    return CategoryIndex(
        table, {name: sizes.get(number, 0) for number, name in enumerate(columns)}, suffix, unseen, hot_keys
    )


def index_categories(
    df: DataFrame, columns: Sequence[str], suffix: str = "_indexed", unseen: str = "error", hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Add the category indexes."""
    return fit_category_index(df, columns, suffix, unseen, hot_keys).transform(df)


@dataclass
class FeatureModel:
    """Category indexes and the vector of some columns, fitted as one."""

    index: CategoryIndex
    assembler: VectorAssembler

    def transform(self, df: DataFrame) -> DataFrame:
        return self.assembler.transform(self.index.transform(df))


def assemble_features(
    df: DataFrame, columns: Sequence[str], out: str = "features", invalid: str = "error"
) -> DataFrame:
    """Number columns to one vector column. ``invalid`` is ``error``, ``skip`` or ``keep``."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=out, handleInvalid=invalid
    ).transform(df)


def fit_features(
    df: DataFrame,
    categories: Sequence[str],
    columns: Sequence[str],
    suffix: str = "_indexed",
    invalid: str = "error",
    hot_keys: int = HOT_KEYS,
) -> FeatureModel:
    """Category indexes and the vector of ``columns`` fitted as one model."""
    index = fit_category_index(df, categories, suffix, invalid, hot_keys)
    return FeatureModel(
        index, VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=invalid)
    )
