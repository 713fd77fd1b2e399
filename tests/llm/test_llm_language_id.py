import numpy as np
import pytest
from llm_rows import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tallywright.llm import language_id as L
from tallywright.llm.queries import QUERIES


def brute_vector(text, dimensions=L.DIMENSIONS):
    runs = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    total = np.zeros(dimensions)
    padded = " " + " ".join(runs) + " "
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        if not runs:
            continue
        va, vb, vc = (L.letter_vector(ord(x), dimensions, L.SEED).astype(float) for x in (a, b, c))
        total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_vectors_equal_a_plain_sum_over_grams():
    for text in ("Ab c", "éa, b!", "a", "x1y2z", "  two  words "):
        got = L.bundle([text.lower()], np.zeros(1, dtype=int), 1, L.DIMENSIONS, L.SEED)[0]
        assert np.array_equal(got, brute_vector(text)), text


def test_batching_and_cutting_change_nothing(monkeypatch):
    texts = ["Der Hund und die Katze", "le chat et le chien", "", "the cat 42", "x" * 50]
    together = L.bundle([t.lower() for t in texts], np.arange(5), 5, 256, 1)
    alone = np.stack([L.bundle([t.lower()], np.zeros(1, dtype=int), 1, 256, 1)[0] for t in texts])
    assert np.array_equal(together, alone)
    monkeypatch.setattr(L, "TABLE_CODES", 1)
    assert np.array_equal(L.bundle([t.lower() for t in texts], np.arange(5), 5, 256, 1), alone)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op1_language_id"](spark, sf).join(truth, "doc_id")
    got = rows.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert got[0] > 0.98 and got[1] > 200
    assert rows.count() == truth.count()


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    languages = L.learn(docs)
    assert set(languages) == {"en", "de", "fr"}
    out = L.identify(docs, languages)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "mark", "lang_pred", "score"]
    rows = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == docs.count()
    for r in rows.values():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert rows[(5, "12 34 !!")].score == 0
    assert L.learn(empty_docs(spark)) == {}
    assert L.identify(empty_docs(spark), languages).count() == 0
    assert {r.lang_pred for r in L.identify(docs, {}).collect()} == {"und"}
    with pytest.raises(ValueError, match="more than 2 languages"):
        L.learn(docs, most=2)


def test_ties_go_to_the_language_that_sorts_first(spark):
    docs = awkward_docs(spark).filter("doc_id = 6")
    one = L.learn(docs)["en"]
    assert L.identify(docs, {"zz": one, "aa": one}).first().lang_pred == "aa"
