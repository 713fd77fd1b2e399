import pytest
from pyspark.sql import functions as F

from tallywright.operators import ranking


@pytest.fixture(scope="module")
def counts(spark):
    rows = [(f"w{k:05d}", k * 7919 % 613) for k in range(3000)]
    return spark.createDataFrame(rows, "word string, count bigint").repartition(5)


@pytest.mark.parametrize("most", [10, 10_000])
def test_reports_of_any_length(counts, monkeypatch, most):
    monkeypatch.setattr(ranking, "REPORT_ROWS", most)
    rows = sorted((r.word, r["count"]) for r in counts.collect())
    falling = sorted(rows, key=lambda r: (-r[1], r[0]))
    rising = sorted(rows, key=lambda r: (r[1], r[0]))
    for n in (1, 25, 2999, 5000):
        assert sorted(tuple(r) for r in ranking.top_words(counts, n).collect()) == sorted(falling[:n])
        assert sorted(tuple(r) for r in ranking.bottom_words(counts, n).collect()) == sorted(rising[:n])
        assert sorted(r.word for r in ranking.preview(counts, "word", n).collect()) == [w for w, _ in rows[:n]]
    with pytest.raises(ValueError):
        ranking.top_words(counts, 0)


@pytest.mark.parametrize("most", [5, 10_000])
def test_class_reports_of_any_length(spark, monkeypatch, most):
    monkeypatch.setattr(ranking, "REPORT_ROWS", most)
    texts = [(k, " ".join(f"t{j:02d}" for j in range(k % 40)), float(k % 3) if k % 7 else None) for k in range(200)]
    df = spark.createDataFrame(texts, "id int, text string, k double").repartition(4)
    found = {}
    for r in ranking.top_terms_by_class(df, "text", "k", 20, None).collect():
        found.setdefault(r.k, []).append((r["rank"], r.term, r["count"]))
    for k in (0.0, 1.0, 2.0):
        seen = {}
        for _, text, own in texts:
            for term in text.split() if own == k else []:
                seen[term] = seen.get(term, 0) + 1
        best = sorted(seen, key=lambda t: (-seen[t], t))[:20]
        assert sorted(found[k]) == [(i + 1, t, seen[t]) for i, t in enumerate(best)]
    weights = {r.term: r.weight for r in ranking.term_weights(df, "text", "k", 1, 12, None).collect()}
    assert len(weights) == 12 and max(weights.values()) == 1.0


def test_a_long_report_has_no_task_that_ranks_all(spark):
    rows = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("word"), (F.col("id") % 1000).alias("count"))
    report = ranking.top_words(rows, 700_000)
    assert report.count() == 700_000 and report.agg(F.min("count")).first()[0] == 300
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Window" not in plan and "SinglePartition" not in plan
