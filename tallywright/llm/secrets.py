"""Secret scans: fixed patterns, and entropy over a sliding window of candidate strings.

Only SQL expressions run. Spark's pattern functions return strings without places; the places
follow from splitting the text at the same pattern: texts between matches and matches alternate,
so running lengths give each match's start and end in code points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.expressions import let, running, settled
from tallywright.llm.text_units import spare_name

# Kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

SPAN = "struct<start:int,kind:int,end:int>"


class CharClass(NamedTuple):
    """An alphabet and the entropy, in bits a character, at which one of its windows is suspect.

    A candidate belongs to the first class whose pattern it matches whole.
    """

    name: str
    pattern: str
    bits: float


#: Window of the entropy scan; shorter strings are no candidates.
WINDOW = 20
CLASSES = (
    CharClass("digits", r"[0-9+/_=-]+", math.inf),
    CharClass("letters", r"[A-Za-z+/_=-]+", math.inf),
    CharClass("hex", r"[0-9a-fA-F]+", 2.9),
    CharClass("upper", r"[A-Z0-9]+", 3.4),
    CharClass("mixed", r"[A-Za-z0-9+/_=-]+", 3.7),
)
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Candidates that match one of these are not reported: identifiers, digests named as such, and
#: placeholders.
ALLOWED = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)sha(1|224|256|384|512)[-=].*",
    r"(?i).*(example|placeholder|changeme|dummy|sample|test_?key|your_).*",
    r"(?i).*(0123456789|abcdefghij|1234567890).*",
    r"(.)\1+",
)


def spans_of(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """Spans of all matches, left to right, whose group has at least so many characters."""
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    tested = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else sizes
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # the gap after the last match has no match of its own
    steps = F.filter(
        F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), tested.alias("tested")), lambda s: s["size"].isNotNull()
    )

    def placed(steps: Column) -> Column:
        passed = F.transform(steps, lambda s: s["gap"] + s["size"])
        return let(
            running(passed, F.lit(0), lambda at, step: at + step),
            lambda ends: F.transform(
                steps,
                lambda s, i: F.struct(
                    (F.get(ends, i) - s["size"]).alias("start"),
                    F.lit(kind).alias("kind"),
                    F.get(ends, i).alias("end"),
                    s["tested"].alias("tested"),
                ),
            ),
        )

    found = F.filter(let(steps, placed), lambda s: s["tested"] >= least)
    return F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"]))


def peak_entropy(string: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits a character, of any window of the string.

    The sum of c * log2(c) over the window's characters is carried along: the character that
    enters and the one that leaves change one count each, and both counts are taken among the
    characters that stay, so a step costs the window's width however long the string is. A string
    shorter than the window is one window.
    """
    weights = [c * math.log2(c) if c else 0.0 for c in range(window + 1)]
    # what one more of a character adds to the sum, by how many there are
    more = F.lit([weights[c + 1] - weights[c] for c in range(window)])

    def of(chars: Column) -> Column:
        def count(part: Column, char: Column) -> Column:
            return F.size(part) - F.size(F.array_remove(part, char))

        def step(a: Column, i: Column) -> Column:
            # the window held places i - window .. i - 1; place i enters, i - window leaves
            stay = F.slice(chars, F.greatest(i - window + 2, F.lit(1)), F.least(i, F.lit(window - 1)))

            def moved(stay: Column) -> Column:
                drop = F.when(i >= window, F.get(more, count(stay, F.get(chars, i - window)))).otherwise(0.0)
                return a["sum"] - drop + F.get(more, count(stay, F.get(chars, i)))

            return let(
                let(stay, moved),
                lambda total: F.struct(
                    total.alias("sum"),
                    F.when(i >= F.least(F.size(chars), F.lit(window)) - 1, F.least(a["low"], total))
                    .otherwise(a["low"])
                    .alias("low"),
                ),
            )

        width = F.least(F.size(chars), F.lit(window)).cast("double")
        return F.aggregate(
            F.sequence(F.lit(0), F.size(chars) - 1),
            F.struct(F.lit(0.0).alias("sum"), F.lit(1e308).alias("low")),
            step,
            lambda a: F.log2(width) - a["low"] / width,
        )

    return let(F.split(string, ""), of)


def is_secret(
    string: Column,
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    window: int = WINDOW,
) -> Column:
    """True if some window of the string is as random as its class allows and no exception holds."""
    limit = F.lit(math.inf)
    for one in reversed(classes):
        limit = F.when(string.rlike(f"^(?:{one.pattern})$"), F.lit(float(one.bits))).otherwise(limit)
    excused = F.lit(False)
    for pattern in allowed:
        excused = excused | string.rlike(f"^(?:{pattern})$")
    return F.when(limit == math.inf, F.lit(False)).when(excused, F.lit(False)).otherwise(
        peak_entropy(string, window) >= limit
    )


def entropy_spans(
    text: Column,
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    window: int = WINDOW,
) -> Column:
    """Spans of the candidate strings that :func:`is_secret` holds for."""
    found = spans_of(text, CANDIDATE, KINDS.index("entropy"))
    strings = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    judged = F.filter(
        F.arrays_zip(found.alias("span"), strings.alias("string")),
        lambda z: is_secret(z["string"], classes, allowed, window),
    )
    return F.transform(judged, lambda z: z["span"])


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    window: int = WINDOW,
) -> DataFrame:
    """Add n_assign, n_access, n_hex (long), base_sha256, spans (string) and secret_spans (array).

    Places are code points, ends exclusive. Spans may overlap: a string found both by a pattern and
    by its entropy is listed twice. Null and empty texts have no spans; an input column of one of
    the added names is replaced. The three pattern kinds do not depend on the allow-list.
    """
    added = {"n_assign", "n_access", "n_hex", "base_sha256", "spans", "secret_spans"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    base, own, whole = (spare_name(docs, stem) for stem in ("base", "own", "whole"))
    none = F.array().cast(f"array<{SPAN}>")
    df = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(whole))
    low, plain = F.lower(F.col(whole)), F.col(whole)
    hinted = F.lit(False)
    for word in ASSIGN_WORDS:
        hinted = hinted | F.contains(F.col(f"{whole}_low"), F.lit(word))
    df = df.withColumn(f"{whole}_low", low)
    parts = {
        "assign": F.when(hinted, spans_of(plain, ASSIGN, 0, LEAST_ASSIGN, group=2)).otherwise(none),
        "access": F.when(
            F.contains(plain, F.lit("AKIA")), spans_of(plain, f"{ACCESS}", 1, LEAST_ACCESS)
        ).otherwise(none),
        "hex": F.when(
            plain.rlike(f"[0-9a-f]{{{LEAST_HEX}}}"), spans_of(plain, HEX[:-1] + f"{{{LEAST_HEX},}}", 2)
        ).otherwise(none),
        "entropy": F.when(
            plain.rlike(CANDIDATE), entropy_spans(plain, classes, allowed, window)
        ).otherwise(none),
    }
    df = df.withColumns({f"{own}_{kind}": spans for kind, spans in parts.items()}).drop(f"{whole}_low")
    df = df.withColumns(
        {
            base: F.array_sort(F.concat(*[F.col(f"{own}_{kind}") for kind in KINDS[:3]])),
            "secret_spans": F.array_sort(F.concat(*[F.col(f"{own}_{kind}") for kind in KINDS])),
        }
    )
    df = settled(
        df,
        {
            "secret_spans": F.col("secret_spans"),
            "n_assign": F.size(f"{own}_assign").cast("long"),
            "n_access": F.size(f"{own}_access").cast("long"),
            "n_hex": F.size(f"{own}_hex").cast("long"),
            "base_sha256": F.sha2(_joined(F.col(base)), 256),
            "spans": _joined(F.col("secret_spans")),
        },
    )
    return df.drop(base, whole, *[f"{own}_{kind}" for kind in KINDS])


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every run of overlapping spans replaced by a mask; spans sorted by start."""

    def masked(chars: Column) -> Column:
        def over(reach: Column) -> Column:
            # a span that starts within the reach of those before it belongs to their run
            heads = F.filter(
                F.transform(
                    spans,
                    lambda s, i: F.struct(s["start"].alias("start"), F.coalesce(F.get(reach, i - 1), F.lit(0)).alias("before"), i.alias("i")),
                ),
                lambda s: (s["start"] >= s["before"]) & (F.get(reach, s["i"]) > s["before"]),
            )
            pieces = F.transform(
                heads,
                lambda s: F.concat(F.array_join(F.slice(chars, s["before"] + 1, s["start"] - s["before"]), ""), F.lit(mask)),
            )
            rest = F.array_join(F.slice(chars, F.element_at(reach, -1) + 1, F.size(chars)), "")
            return F.concat(F.array_join(pieces, ""), rest)

        ends = F.transform(spans, lambda s: s["end"])
        return let(running(ends, F.lit(0), lambda a, b: F.greatest(a, b)), over)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.split(text, ""), masked))
