import re

import pytest
from pyspark.sql import functions as F

from tallywright.functions import text as T
from tallywright.operators import text
from tallywright.plans import inputs
from tallywright.plans.oracles import STOP_WORDS

ODD = [
    "  a b c\x1cd\u0085e\x0bf ",
    "Été naïve_x 42 a - b!! I'm ٣",
    "x² ½ कि १२ naïvé a‍b",
    "",
    " ",
    "tab\tnew\nline\r\nend",
    "a b c d e f　g",
]


def python_clean(value):
    value = re.sub(r"\s+", " ", re.sub(r"\d+", "", value.lower()))
    return re.sub(r"[^\w\s]", "", value)


@pytest.fixture(scope="module")
def texts(spark, small):
    given = [row.text for row in inputs.documents(spark, small).collect()]
    return spark.createDataFrame(list(enumerate(ODD + given)), "id int, text string").persist()


def test_words_equal_python_split(texts):
    for row in texts.withColumn("n", T.blank_word_count("text")).withColumn(
        "words", F.filter(T.blank_split("text"), lambda w: w != "")
    ).collect():
        assert row.words == row.text.split()
        assert row.n == len(row.text.split())


def test_terms_equal_python_pattern(texts):
    for row in texts.withColumn("terms", T.terms("text")).collect():
        assert row.terms == re.findall(r"\b\w\w+\b", row.text.lower())


def test_cleaning_equals_python(texts):
    for row in texts.withColumn("clean", T.cleaned("text")).collect():
        assert row.clean == python_clean(row.text)


def test_cleaning_keeps_double_blank_and_underscore(strings):
    df = text.clean_text(strings("Été naïve_x 42 a - b!! I'm ٣"), "value")
    assert df.first().value == "été naïve_x a  b im "


def test_ascii_split_leaves_other_blanks(strings):
    words = text.tokenize_ws(strings("a b c"), unicode=False)
    assert sorted(row.word for row in words.collect()) == ["a b", "c"]


def test_terms_with_stop_list_keep_repeats(strings):
    df = text.tokenize_terms(strings("The cat the CAT of"), "value", stop_words=["the", "of"])
    assert [row.term for row in df.collect()] == ["cat", "cat"]


def test_null_text_has_no_terms(strings):
    assert text.tokenize_terms(strings(None), "value").count() == 0


def test_listed_stop_words_are_those_of_spark(spark):
    assert T.stop_list("english") == STOP_WORDS
    assert T.stop_list(None) == []
