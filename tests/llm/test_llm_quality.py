import random
import re
import time
from collections import Counter

from llm_rows import WORD, awkward_docs, empty_docs, prose
from pyspark.sql import functions as F

from tallywright.llm import quality
from tallywright.llm.text_units import words_of
from tallywright.session import materialize


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


TEXTS = ["a b c a b c", "a b c d a b c", "x " * 100, "a b a b a", "# * $ %\n\n#\n#\n \n", "é𝔘 | <b> " * 60, prose(500, 1) + " " + prose(500, 1)]


def test_counts_equal_brute_force_on_awkward_rows(spark):
    docs = awkward_docs(spark).select("doc_id", "text").union(
        spark.createDataFrame([(5000 + k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string")
    )
    rows = quality.score_quality(docs.withColumn("kept", F.lit("old")).withColumn("__words", F.lit(1))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        expected = brute(r.text)
        assert {k: r[k] for k in expected} == expected
        assert r.kept == (r.failed_rule is None) and (r.failed_rule == "base") == expected["base_failed"]
    assert quality.score_quality(empty_docs(spark)).count() == 0


def test_short_hashes_fall_back_to_whole_ones(spark, monkeypatch):
    texts = [prose(300, k) + " " + prose(40, k) for k in range(5)] + TEXTS
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("w", words_of(F.col("text")))
    expected = [brute(t)["n_repeat_words"] for t in texts]
    for bits in (58, 60, 5):  # few hash bits: different windows meet; few places: texts are longer
        monkeypatch.setattr(quality, "PLACE_BITS", bits)
        monkeypatch.setattr(quality, "_PLACE_MASK", (1 << bits) - 1)
        got = quality.with_repeat_words(df, "w", "n").select("text", "n").collect()
        assert [r.n for r in got] == expected


def test_order_follows_rejection_per_cost_and_keeps_the_verdict(spark):
    rules = [quality.Rule(n, F.lit(False)) for n in "abc"]
    measured = [quality.Measured(rules[0], 1.0, 0.1), quality.Measured(rules[1], 0.1, 0.1), quality.Measured(rules[2], 2.0, 0.0)]
    assert [r.name for r in quality.order_rules(measured)] == ["b", "a", "c"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    parts = docs.withColumns({"w": words_of(F.col("text")), "l": quality.lines_with_words(F.col("text")), "s": quality.n_symbols(F.col("text"))})
    rules = quality.default_rules("text", "w", "l", "s")
    one = parts.select("doc_id", quality.cascade(rules).isNull().alias("a"), quality.cascade(rules[::-1]).isNull().alias("b"))
    assert one.filter("a != b").count() == 0


def test_clean_prose_stays_and_junk_goes(spark):
    clean = [prose(60, k).capitalize() + ". " + prose(3000, k) for k in range(5)]
    junk = [" ".join(w + "###" for w in prose(80, 1).split()), prose(80, 2).upper() + " !!", " | ".join(prose(80, 3).split()), "same " * 90]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(clean + junk)], "doc_id bigint, text string")
    kept = {r.doc_id for r in quality.score_quality(df).filter("kept").collect()}
    assert kept == set(range(len(clean)))


def test_filters_on_the_result_cost_no_more_than_the_result(spark):
    rng = random.Random(6)
    docs = [(k, prose(20_000, k) + " " + " ".join(rng.choices("a b c".split(), k=400))) for k in range(4)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    scored = quality.score_quality(df)
    started = time.perf_counter()
    assert scored.filter("kept").count() == 4
    assert scored.filter("n_repeat_words > 10 and not base_failed").select("doc_id").count() == 4
    assert scored.filter("failed_rule is not null or n_words < 3").count() == 0
    assert time.perf_counter() - started < 60
    plain, filtered = (len(x._jdf.queryExecution().optimizedPlan().toString()) for x in (scored, scored.filter("kept")))
    assert filtered < plain + 500


def test_a_dear_rule_comes_after_a_cheap_one_as_measured(spark):
    df = spark.createDataFrame([(prose(400, k),) for k in range(200)], "text string").withColumn("w", words_of(F.col("text")))
    sample = materialize(df, "sample")
    digest = F.col("text")
    for _ in range(12):
        digest = F.sha2(F.concat(F.col("text"), digest), 512)
    dear = quality.Rule("dear", (F.length(digest) > 0) & F.col("text").contains("ka"))
    cheap = quality.Rule("cheap", F.col("text").contains("ka"))
    never = quality.Rule("never", F.size("w") < 0)
    measured = quality.measure_rules(sample, [dear, never, cheap])
    cost = {m.rule.name: m.cost for m in measured}
    share = {m.rule.name: m.rejection for m in measured}
    assert cost["dear"] > 5 * cost["cheap"] and share["dear"] == share["cheap"] > 0.9 and share["never"] == 0
    assert [r.name for r in quality.order_rules(measured)] == ["cheap", "dear", "never"]


def test_no_python_runs(spark):
    plan = quality.score_quality(awkward_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
