"""Awkward rows that every operator must take, and plain reference computations."""

from __future__ import annotations

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")

SYLLABLES = "ka lo mi ne ru ta vo si po de".split()


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def awkward_docs(spark):
    """Null and empty texts, blanks only, one word, repeats, a very long text, a hot source, odd columns."""
    long_text = prose(30_000, 1)
    rows = [
        (1, None, "en", "src0"), (2, "", "en", "src0"), (3, " \t\n\x0b\r ", None, None), (4, "Word", "en", "src1"),
        (5, "12 34 !!", "de", "src1"), (6, prose(60, 2), "en", "src0"), (7, prose(60, 2), "en", "src0"),
        (7, prose(60, 2), "en", "src0"), (8, long_text, "fr", "src0"), (9, long_text + " end", "fr", "src0"),
        (10, prose(59, 2).upper(), "en", None), (11, "über naïve   x", "de", "src2"),
        (None, prose(40, 3), "en", "src0"), (None, None, None, "src0"),
        *[(100 + k, prose(45, 4) + f" tail{k % 3}", "en", "src0") for k in range(40)],
    ]
    return spark.createDataFrame(
        [(*row, len(row[1] or ""), "x", 1.5) for row in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, mark string, score double",
    )


def empty_docs(spark):
    return awkward_docs(spark).limit(0)
