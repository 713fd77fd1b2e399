"""Quality rules as a short-circuit cascade of SQL expressions.

Every rule is a boolean expression over the text, its words and a few counts. Cost and rejection
rate of each rule are measured on a bounded sample; the rules are then chained in one ``CASE`` by
rejection per cost, so that most bad documents are rejected by cheap expressions and the dear ones
are evaluated only for what is left. The order never changes which documents are kept.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.expressions import settled
from tallywright.llm.text_units import spare_name, words_of
from tallywright.session import materialize

#: Rows that costs and rejections are measured on, in expectation.
SAMPLE_ROWS = 2_000
#: Times a rule is evaluated on each of them.
REPEATS = 10
# Symbols counted, and the limits of the base rule.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

#: Columns that the scores add.
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rule", "kept")

#: Low bits that hold a window's place when windows are sorted by hash; the rest is hash.
PLACE_BITS = 24
_PLACE_MASK = (1 << PLACE_BITS) - 1


class Rule(NamedTuple):
    """A named expression that is true for a document to reject; null counts as false."""

    name: str
    rejects: Column


class Measured(NamedTuple):
    """What the sample says of a rule: seconds per row and share of rows rejected."""

    rule: Rule
    cost: float
    rejection: float


def word_chars(text: Column, words: Column) -> Column:
    """Code points in words."""
    return F.length(F.concat_ws("", words)).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(lines: Column) -> Column:
    """Lines that equal an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words that lie in a 3-word window found twice or more in the text.

    Windows are sorted inside the row, as one long each: hash in the high bits, place in the low
    ones. Equal neighbours are repeated windows. The 64-bit hashes are compared again for those
    candidates; where the shortened hash brought different windows together (or a text has more
    windows than places), the row is sorted again by the whole hash.
    """
    hashes, packed, twice, spare = (spare_name(df, stem) for stem in ("hash", "pack", "twice", "at"))
    n = F.size(words)

    def at(array: str, i: Column) -> Column:
        return F.get(F.col(array), i)

    df = df.withColumn(
        hashes,
        F.when(
            n >= 3,
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.xxhash64(at(words, i), at(words, i + 1), at(words, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    keep = F.lit(~_PLACE_MASK)
    df = df.withColumn(
        packed,
        F.sort_array(F.transform(hashes, lambda x, i: x.bitwiseAND(keep).bitwiseOR(i.cast("long")))),
    )

    def same(x: Column, y: Column) -> Column:
        return F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)

    df = df.withColumn(twice, F.filter(packed, lambda x, i: (i > 0) & same(x, at(packed, i - 1))))
    df = df.withColumn(
        twice,
        F.when(F.size(twice) == 0, F.col(twice)).otherwise(
            F.filter(packed, lambda x, i: same(x, at(packed, i - 1)) | same(x, at(packed, i + 1)))
        ),
    )

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_PLACE_MASK)).cast("int")

    def hash_at(x: Column) -> Column:
        return at(hashes, place(x))

    mixed = F.exists(
        F.sequence(F.lit(1), F.size(twice) - 1),
        lambda i: same(at(twice, i), at(twice, i - 1))
        & (hash_at(at(twice, i)) != hash_at(at(twice, i - 1))),
    )
    whole = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    exact = F.transform(
        F.filter(
            F.transform(
                F.arrays_zip(
                    whole.alias("x"),
                    F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), whole).alias("before"),
                    F.slice(whole, F.lit(2), F.size(whole)).alias("after"),
                ),
                lambda z: F.struct(
                    z["x"]["i"].alias("i"),
                    (
                        F.coalesce(z["x"]["h"] == z["before"]["h"], F.lit(False))
                        | F.coalesce(z["x"]["h"] == z["after"]["h"], F.lit(False))
                    ).alias("again"),
                ),
            ),
            lambda z: z["again"],
        ),
        lambda z: z["i"],
    )
    nothing = F.array().cast("array<int>")
    df = df.withColumn(
        spare,
        F.when(n > _PLACE_MASK, exact)
        .when(F.size(twice) == 0, nothing)
        .when(mixed, exact)
        .otherwise(F.transform(twice, place)),
    )
    covered = F.aggregate(
        F.sort_array(spare),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )
    return settled(df, {out: covered}).drop(hashes, packed, twice, spare)


def default_rules(text: str, words: str, lines: str, symbols: str) -> list[Rule]:
    """Rules of the web-corpus kind; limits are meant to leave ordinary prose of any length alone."""
    n = F.size(words)
    size = F.length(F.concat_ws("", F.col(words)))
    return [
        Rule("symbols", F.col(symbols) * 10 > n),
        Rule("word_length", (size < 2 * n) | (size > 20 * n)),
        Rule("duplicate_lines", (F.size(lines) - F.size(F.array_distinct(lines))) * 10 > F.size(lines) * 3),
        Rule("shouting", F.regexp_count(F.col(text), F.lit(r"\p{Lu}")) * 2 > size),
        Rule("marks", F.regexp_count(F.col(text), F.lit("[!?]")) * 2 > n),
    ]


def draw_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """About ``rows`` random rows of the table, all of them if it has no more.

    The share follows from the row count, so that no task has to gather what others have drawn.
    """
    n = docs.count()
    return docs.sample(min(1.0, rows / n), seed) if n > rows else docs


def measure_rules(sample: DataFrame, rules: Sequence[Rule], repeats: int = REPEATS) -> list[Measured]:
    """Cost and rejection of each rule over the rows of a stored sample.

    A rule is evaluated ``repeats`` times a row; the time of a job that evaluates an empty rule as
    often is taken off, so that starting a job and reading the sample do not count as the rule's.
    """
    again = sample.withColumn(spare_name(sample, "turn"), F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def timed(rejects: Column) -> tuple[float, int, int]:
        probe = again.agg(F.count(F.lit(1)).alias("n"), F.count_if(rejects).alias("bad"))
        seconds = []
        for _ in range(3):  # the first run also compiles
            started = time.perf_counter()
            row = probe.first()
            seconds.append(time.perf_counter() - started)
        return min(seconds), row["n"], row["bad"]

    idle, _, _ = timed(F.lit(False))
    measured = []
    for rule in rules:
        seconds, n, bad = timed(rule.rejects)
        measured.append(Measured(rule, max(seconds - idle, 0.0) / max(n, 1), bad / max(n, 1)))
    return measured


def order_rules(measured: Sequence[Measured]) -> list[Rule]:
    """Rules by falling rejection per cost; ties keep the given order."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.rejection / max(m.cost, 1e-12))]


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the row, null if none does. Later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def score_quality(
    docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Base counts, the base verdict and the cascade's verdict for every row.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed (boolean),
    failed_rule (string or null) and kept (boolean); an input column of one of these names is
    replaced. A null or empty text has no words and so fails the base rule; equal rows get equal
    verdicts; an empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    words, lines = spare_name(docs, "words"), spare_name(docs, "lines")

    def with_parts(df: DataFrame) -> DataFrame:
        parts = {words: words_of(F.col(text)), lines: lines_with_words(F.col(text))}
        return df.withColumns({**parts, "n_symbols": n_symbols(F.col(text))})

    parts = with_parts(docs.select(*[F.col(f"`{c}`") for c in kept]))
    rules = default_rules(text, words, lines, "n_symbols")
    sample = materialize(with_parts(draw_sample(docs.select(F.col(f"`{text}`")), rows)), "quality-sample")
    rules = order_rules(measure_rules(sample, rules))
    counted = with_repeat_words(parts, words, "n_repeat_words").withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": word_chars(F.col(text), F.col(words)),
            "n_dup_lines": n_dup_lines(F.col(lines)),
        }
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    judged = counted.withColumn("base_failed", failed)
    judged = judged.withColumn(
        "failed_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rules))
    )
    return settled(
        judged,
        {**{c: F.col(c) for c in ADDED[:-1]}, "kept": F.col("failed_rule").isNull()},
    ).drop(words, lines)
