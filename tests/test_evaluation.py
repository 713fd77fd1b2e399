import math
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tallywright.operators import evaluation

PAIRS = [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 7 + [(1.0, 1.0)] * 20 + [(1.0, 0.0)] * 3 + [(2.0, 1.0)] * 4


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "label double, prediction double").repartition(4)


@pytest.mark.parametrize("name", ["rmse", "mae"])
def test_regression_metrics_equal_mllib(pairs, name):
    expected = RegressionEvaluator(labelCol="label", metricName=name).evaluate(pairs)
    assert math.isclose(getattr(evaluation, name)(pairs).first()[0], expected)


def test_class_metrics_equal_mllib(pairs):
    def mllib(name, **options):
        return MulticlassClassificationEvaluator(metricName=name, **options).evaluate(pairs)

    assert math.isclose(evaluation.accuracy(pairs).first()[0], mllib("accuracy"))
    assert math.isclose(evaluation.f1_weighted(pairs).first()[0], mllib("f1"))
    report = {r["class"]: r for r in evaluation.classification_report(pairs).collect()}
    for label in (0.0, 1.0):
        assert math.isclose(report[str(label)].precision, mllib("precisionByLabel", metricLabel=label))
        assert math.isclose(report[str(label)].recall, mllib("recallByLabel", metricLabel=label))
    assert math.isclose(report["weighted avg"].precision, mllib("weightedPrecision"))
    assert report["accuracy"].support == len(PAIRS)


def test_class_never_predicted(pairs):
    row = evaluation.classification_report(pairs).filter("class = '2.0'").first()
    assert (row.precision, row.recall, row.f1, row.support) == (0.0, 0.0, 0.0, 4)


def test_confusion_matrix_keeps_zero_cells(pairs):
    cells = {(r.label, r.prediction): r["count"] for r in evaluation.confusion_matrix(pairs).collect()}
    assert len(cells) == 9
    assert cells[2.0, 2.0] == 0 and cells[1.0, 0.0] == 3
    assert sum(cells.values()) == len(PAIRS)


def test_labels_of_another_type_than_predictions(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0)], "label int, prediction double")
    cells = {(r.label, r.prediction): r["count"] for r in evaluation.confusion_matrix(df).collect()}
    assert cells == {(1, 1): 1, (0, 1): 1, (1, 0): 0, (0, 0): 0}


def test_many_classes(spark):
    """5,000 classes: sparse counts and the report; the grid of 300."""
    df = spark.range(20_000).select((F.col("id") % 5000).alias("label"), (F.col("id") * 7 % 5003).alias("prediction"))
    rows = [(k % 5000, k * 7 % 5003) for k in range(20_000)]
    cells = evaluation.confusion_matrix(df, zeros=False)
    assert {(r.label, r.prediction): r["count"] for r in cells.collect()} == Counter(rows)
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert len(report) == 5003 + 3 and report["17"].support == 4
    assert math.isclose(report["accuracy"].f1, sum(a == b for a, b in rows) / len(rows))
    small = df.filter("label < 300 and prediction < 300")
    counts = Counter(r for r in rows if max(r) < 300)
    classes = {c for pair in counts for c in pair}
    grid = {(r.label, r.prediction): r["count"] for r in evaluation.confusion_matrix(small).collect()}
    assert grid == {(a, b): counts[a, b] for a in classes for b in classes}
    plan = evaluation.confusion_matrix(small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "collect_list" not in plan


def test_all_classes_and_null_fill_the_whole_grid(spark):
    sides = [None, 0, 1, 2]
    df = spark.createDataFrame([(a, b) for a in sides for b in sides], "label int, prediction int")
    assert evaluation.confusion_matrix(df).agg({"count": "sum"}).first()[0] == 16
    assert evaluation.classification_report(df).count() == 4 + 3
    assert evaluation.confusion_matrix(df.limit(0)).count() == 0


def test_a_prediction_between_classes_is_a_miss(spark):
    df = spark.createDataFrame([(0, 0.7), (1, 1.0)], "label int, prediction double")
    cells = {(r.label, r.prediction): r["count"] for r in evaluation.confusion_matrix(df).collect()}
    assert cells[(1, 1)] == 1 and cells.get((0, 0), 0) == 0 and cells[(0, None)] == 1
    assert evaluation.accuracy(df).first()[0] == 0.5


def test_model_comparison(pairs):
    rows = evaluation.compare_models({"a": pairs, "b": pairs.filter("label = 0")}).collect()
    shares = {r.model: r.value for r in rows if r.measure == "accuracy"}
    assert math.isclose(shares["b"], 50 / 57)
    assert sum(r.value for r in rows if r.model == "a" and r.measure == "count") == len(PAIRS)
