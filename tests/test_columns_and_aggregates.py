import math

import pytest

from tallywright.operators import aggregates, columns, ranking


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split_fields_edge_rows(strings):
    spec = {"department": (0, "string"), "salary": (1, "float")}
    df = columns.split_fields(strings("sales 1.5", "sales abc", "nosep", "x  7"), " ", spec)
    assert [(r.department, r.salary) for r in df.collect()] == [
        ("sales", 1.5),
        ("sales", None),
        ("nosep", None),
        ("x", None),
    ]


def test_sum_keeps_null_groups_and_float_values(strings):
    spec = {"department": (0, "string"), "salary": (1, "float")}
    df = columns.split_fields(strings("a 0.1", "a 0.2", "b x"), " ", spec)
    got = dict(rows(aggregates.sum_by(df, "department", "salary")))
    assert got["b"] is None
    assert math.isclose(got["a"], 0.30000000447034836)


def test_field_count_shows_ragged_lines(strings):
    assert rows(columns.field_count(strings("a,b", "c,d", "e", "f,"))) == [(1, 1), (2, 3)]


def test_parity_of_negative_null_and_huge_numbers(strings):
    numbers = columns.cast_columns(
        strings("-3", "-2", "0", "7", "abc", "123456789012345678901"), {"value": "decimal(38,0)"}
    )
    labels = [r.parity for r in columns.parity_label(numbers, "value").collect()]
    assert labels == ["Odd", "Even", "Even", "Odd", None, "Odd"]
    assert dict(rows(aggregates.parity_count(numbers, "value"))) == {"Even": 2, "Odd": 3, None: 1}


def test_binary_label_counts_null_as_attack(strings):
    df = columns.binarize_label(strings("normal.", "normal", "smurf.", None), "value")
    assert [r.new_label for r in df.collect()] == ["normal", "attack", "attack", "attack"]


def test_drops_and_filters(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "b"), (float("nan"), ""), (0.0, None)], "k double, t string"
    )
    assert rows(columns.drop_null_rows(df, ["k"])) == [(0.0, None), (1.0, "a")]
    assert columns.drop_columns(df, ["t"]).columns == ["k"]
    with pytest.raises(ValueError):
        columns.drop_columns(df, ["missing"])
    assert [r.t for r in columns.filter_nonempty(df, "t").collect()] == ["a", "b"]
    assert rows(columns.filter_class(df, "k", 1)) == [(1.0, "a")]


def test_line_count_and_empty_input(strings):
    assert rows(aggregates.line_count(strings("a", "b", ""))) == [("line", 3)]
    assert aggregates.line_count(strings("a").limit(0)).count() == 0


def test_count_by_orders_and_nulls(strings):
    df = strings("b", "a", "c", "c", None)
    up = [tuple(r) for r in aggregates.count_by(df, "value").collect()]
    assert up == [(None, 1), ("a", 1), ("b", 1), ("c", 2)]
    down = aggregates.count_by(df, "value", ascending=False, drop_nulls=True).collect()
    assert [tuple(r) for r in down] == [("c", 2), ("a", 1), ("b", 1)]


def test_selected_words_are_whole_tokens(strings):
    df = strings("Lord, Lord lord", "Lord's WORLD")
    got = rows(aggregates.selected_word_count(df, "value", ["Lord", "WORLD", "Library"]))
    assert got == [("Lord", 1), ("WORLD", 1)]


def test_top_and_bottom_words_break_ties_by_word(strings):
    counts = aggregates.word_count(strings("b a c c", "  d d d"))
    assert [r.word for r in ranking.top_words(counts, 3).collect()] == ["d", "c", "a"]
    assert [r.word for r in ranking.bottom_words(counts, 3).collect()] == ["a", "b", "c"]


def test_top_rated(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (1, 3.0)], "movieId int, rating double")
    got = [tuple(r) for r in ranking.top_rated(df, "movieId", n=2).collect()]
    assert got == [(2, 5.0), (1, 4.0)]


def test_terms_by_class_and_weights(spark):
    df = spark.createDataFrame(
        [(1.0, "buy now now"), (1.0, "buy buy"), (0.0, "nice nice song"), (None, "lost words")],
        "CLASS double, CONTENT string",
    )
    best = ranking.top_terms_by_class(df, "CONTENT", "CLASS", 1, stop_words=["now"])
    assert sorted((r.CLASS, r.term, r["count"]) for r in best.collect()) == [
        (0.0, "nice", 2),
        (1.0, "buy", 3),
    ]
    cloud = ranking.term_weights(df, "CONTENT", "CLASS", 1, stop_words=None)
    assert [tuple(r) for r in cloud.orderBy("term").collect()] == [
        ("buy", 3, 1.0),
        ("now", 2, 2 / 3),
    ]


def test_log_density_puts_non_positive_values_in_null(spark):
    df = spark.createDataFrame(
        [("x", 0.0, 10.0), ("x", 99.0, 1000.0), ("x", 10.0, 9999.0)], "l string, a double, b double"
    )
    got = {(r.bucket_x, r.bucket_y): r["count"] for r in aggregates.log_density(df, "a", "b", "l").collect()}
    assert got == {(None, 1): 1, (1, 3): 2}


def test_palette_and_duplicates(strings):
    df = strings("normal.", "smurf.", "smurf.", None)
    assert rows(aggregates.label_palette_keys(df, "value")) == [
        ("normal.", True),
        ("smurf.", False),
        (None, False),
    ]
    assert aggregates.drop_duplicate_rows(df).count() == 3


def test_preview_needs_a_bounded_size(strings):
    assert [r.value for r in ranking.preview(strings("c", "a", "b"), "value", 2).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        ranking.preview(strings("a"), "value", 0)
