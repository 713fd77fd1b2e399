import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import Normalizer
from pyspark.sql import functions as F

from tallywright.operators import features

DOCS = [
    (0, "the cat and the dog", 1.0),
    (1, "The dog!", 0.0),
    (2, "", 1.0),
    (3, None, None),
    (4, "cat cat bird", 0.0),
]


def tfidf(docs, size, stop=()):
    tokens = {i: [t for t in re.findall(r"\b\w\w+\b", (text or "").lower()) if t not in stop]
              for i, text, _ in docs}
    seen = Counter(t for words in tokens.values() for t in words)
    vocabulary = sorted(seen, key=lambda t: (-seen[t], t))[:size]
    found = Counter(t for words in tokens.values() for t in set(words))
    idf = {t: math.log((1 + len(docs)) / (1 + found[t])) + 1 for t in vocabulary}
    weights = {}
    for i, words in tokens.items():
        raw = {t: n * idf[t] for t, n in Counter(words).items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights |= {(i, t): w / norm for t, w in raw.items()}
    return weights


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, text string, k double").repartition(3)


@pytest.mark.parametrize("size, stop", [(100, ()), (3, ()), (100, ("the", "and"))])
def test_weights_equal_the_formula(docs, size, stop):
    got = {(r.id, r.term): r.weight for r in
           features.tfidf_long(docs, "text", ["id"], size, list(stop)).collect()}
    expected = tfidf(DOCS, size, stop)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[key], expected[key]) for key in expected)


def test_vectors_have_unit_length_and_empty_rows_stay(docs):
    rows = features.tfidf_vectors(docs, "text", 100).select("id", "features").collect()
    norms = {r.id: np.linalg.norm(r.features.toArray()) for r in rows}
    assert {i for i, norm in norms.items() if norm == 0} == {2, 3}
    assert all(math.isclose(n, 1) for i, n in norms.items() if i in (0, 1, 4))


def test_vocabulary_can_be_fitted_on_training_rows(docs):
    train = docs.filter("id < 2")
    terms = features.tfidf_long(docs, "text", ["id"], 100, fit_on=train).select("term").distinct()
    assert {r.term for r in terms.collect()} == {"the", "cat", "and", "dog"}
    assert features.fit_tfidf(train, "text", 100).rows == 2


def test_class_means_count_zeros_and_break_ties_downwards(docs):
    weights = tfidf(DOCS, 100)
    rows = features.mean_tfidf_by_class(docs, "text", "k", 1, 10, 100, stop_words=None).collect()
    means = {t: sum(w for (i, u), w in weights.items() if u == t and i in (0, 2)) / 2
             for t in ("the", "cat", "and", "dog", "bird")}
    assert [r.term for r in rows] == sorted(means, key=lambda t: (means[t], t), reverse=True)
    assert all(math.isclose(r.score, means[r.term], abs_tol=1e-12) for r in rows)


BY_TABLE = {"broadcast_terms": 0}


@pytest.mark.parametrize("size, stop", [(100, ()), (3, ()), (None, ("the", "and"))])
@pytest.mark.parametrize("hot_terms", [0, 2, 1000])
def test_weights_of_a_vocabulary_table_equal_the_formula(docs, size, stop, hot_terms):
    got = features.tfidf_long(docs, "text", ["id"], size, list(stop), hot_terms=hot_terms, **BY_TABLE)
    expected = tfidf(DOCS, size or 100, stop)
    found = {(r.id, r.term): r.weight for r in got.collect()}
    assert found.keys() == expected.keys() and got.count() == len(expected)
    assert all(math.isclose(found[key], expected[key]) for key in expected)


def test_vectors_of_a_vocabulary_table_equal_the_broadcast_ones(docs):
    rows = docs.withColumn("__row", F.lit(1))
    one, two = (
        {r.id: r.features for r in features.tfidf_vectors(rows, "text", 4, **fit).collect()}
        for fit in ({}, {"hot_terms": 1, **BY_TABLE})
    )
    assert one.keys() == two.keys() == set(range(5))
    for i in one:
        assert one[i].size == two[i].size == 4 and list(one[i].indices) == list(two[i].indices)
        assert np.allclose(one[i].values, two[i].values)
    model = Normalizer(inputCol="features", outputCol="again")
    assert model.transform(features.tfidf_vectors(docs, "text", 4, **BY_TABLE)).count() == 5


def test_a_vocabulary_table_ranks_many_terms(spark, monkeypatch):
    texts = [(k, " ".join(f"w{(k * j) % 997:03d}" for j in range(30)) + " every") for k in range(400)]
    df = spark.createDataFrame(texts, "id int, text string").repartition(6)
    placed = features.with_place
    monkeypatch.setattr(features, "with_place", lambda *args: placed(*args, task_rows=100))
    docs = [(i, t, 0.0) for i, t in texts]
    for size in (None, 500):
        model = features.fit_tfidf(df, "text", size, hot_terms=5, **BY_TABLE)
        whole = features.fit_tfidf(df, "text", size or 10_000)
        places = {r.term: r.place for r in model.vocabulary.collect()}
        assert [t for t, _ in sorted(places.items(), key=lambda x: x[1])] == whole.terms and model.size == len(whole.terms)
        expected = tfidf(docs, size or 10_000)
        got = {(r.id, r.term): r.weight for r in model.long(df, "text", ["id"]).collect()}
        assert got.keys() == expected.keys() and all(math.isclose(got[k], expected[k]) for k in expected)


@pytest.mark.parametrize("size", [None, 5000])
def test_a_long_row_is_scaled_by_one_norm(docs, size):
    """The sum of squares stands in the array of one norm, not in the division of each entry."""
    weights = features.tfidf_long(docs, "text", ["id"], size, broadcast_terms=0, hot_terms=1)
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "array(SQRT(aggregate(" in plan and "/ SQRT(" not in plan


def test_vectors_of_a_long_row_are_scaled_by_one_norm(spark):
    """A norm for each entry would take 2.5 thousand million steps."""
    words = [" ".join(f"w{i}" for i in range(n)) for n in (30_000, 40_000)]
    df = spark.createDataFrame(list(enumerate(words)), "id int, text string")
    began = time.monotonic()
    rows = features.tfidf_vectors(df, "text", None, broadcast_terms=0).orderBy("id").collect()
    assert time.monotonic() - began < 40
    assert [row.features.numNonzeros() for row in rows] == [30_000, 40_000]
    for row in rows:
        assert math.isclose(float(np.linalg.norm(row.features.values)), 1.0, rel_tol=1e-9)


def test_class_means_from_a_vocabulary_table(docs):
    one, two = (features.mean_tfidf_by_class(docs, "text", "k", 1, 10, 100, None, **fit).collect() for fit in ({}, BY_TABLE))
    assert [r.term for r in one] == [r.term for r in two]
    assert all(math.isclose(a.score, b.score, abs_tol=1e-12) for a, b in zip(one, two, strict=True))


def test_vocabulary_size_is_checked(docs):
    with pytest.raises(ValueError):
        features.fit_tfidf(docs, "text", 0)
    empty = features.fit_tfidf(docs.limit(0), "text", None)
    assert (empty.size, empty.rows) == (0, 0) and empty.long(docs, "text", ["id"]).count() == 0
    with pytest.raises(ValueError):
        empty.vectors(docs, "text")


@pytest.mark.parametrize("hot_keys", [0, 1, 1000])
def test_category_ties_are_alphabetical(strings, hot_keys):
    df = strings("b", "a", "c", "c")
    rows = features.index_categories(df, ["value"], hot_keys=hot_keys).collect()
    assert len(rows) == 4 and {r.value: r.value_indexed for r in rows} == {"c": 0.0, "a": 1.0, "b": 2.0}


@pytest.mark.parametrize("hot_keys", [0, 3, 1000])
def test_indexes_of_hot_and_many_categories(spark, hot_keys):
    """Two wide columns, one with a category that half of the rows have, and numbers as categories."""
    rows = [("hot" if k % 2 else f"c{k % 600:03d}", k % 90, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "`a.b` string, n int, id int").repartition(5)
    got = features.index_categories(df, ["a.b", "n"], hot_keys=hot_keys)
    for position, name in ((0, "a.b"), (1, "n")):
        counts = Counter(str(r[position]) for r in rows)
        order = sorted(counts, key=lambda c: (-counts[c], c))
        found = {(str(r[name]), r[name + "_indexed"]) for r in got.collect()}
        assert found == {(c, float(i)) for i, c in enumerate(order)}
    assert got.count() == 3000


def test_unseen_and_null_categories(spark):
    seen = spark.createDataFrame([("x",), ("y",), ("x",)], "c string")
    other = spark.createDataFrame([("x",), (None,), ("z",)], "c string")
    for hot_keys in (0, 1000):
        def places(unseen):
            rows = features.fit_category_index(seen, ["c"], unseen=unseen, hot_keys=hot_keys).transform(other).collect()
            return sorted((str(r.c), r.c_indexed) for r in rows)

        assert places("keep") == [("None", 2.0), ("x", 0.0), ("z", 2.0)]
        assert places("skip") == [("x", 0.0)]
        with pytest.raises(Exception, match="no place for the category"):
            places("error")
    nothing = features.fit_category_index(seen.limit(0), ["c"], unseen="keep")
    assert [r.c_indexed for r in nothing.transform(seen).collect()] == [0.0] * 3


def test_fitted_features(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "c string, n double")
    rows = features.fit_features(df, ["c"], ["n", "c_indexed"]).transform(df).collect()
    assert [list(r.features.toArray()) for r in rows] == [[1.0, 0.0], [2.0, 1.0], [3.0, 0.0]]
    missing = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    assert features.assemble_features(missing, ["a", "b"], invalid="skip").count() == 1
