import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tallywright.llm import divergence as D
from tallywright.llm import packed_terms as P

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, least, ranks=D.TERM_RANKS):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    n, held, groups = Counter(), Counter(), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = terms_of(text)
        n.update((lang, source, t) for t in own)
        held.update((lang, t) for t in set(own))
    kept = defaultdict(list)
    for (lang, term), count in held.items():
        if count >= least:
            kept[lang].append(term)
    p, q = {}, {}
    for lang in {g[0] for g in groups}:
        sources = [s for name, s in groups if name == lang]
        v = len(kept[lang])
        whole = sum(n[lang, s, t] for s in sources for t in kept[lang])
        for s in sources:
            total = sum(n[lang, s, t] for t in kept[lang])
            for t in kept[lang]:
                p[lang, s, t] = 1 + 10**9 * (n[lang, s, t] + 5) // (total + 5 * v)
        for t in kept[lang]:
            q[lang, t] = 1 + 10**9 * (sum(n[lang, s, t] for s in sources) + 5) // (whole + 5 * v)
    out = []
    for lang, source in groups:
        pairs = [(o, sum(abs(p[lang, source, t] - p[lang, o, t]) for t in kept[lang])) for name, o in groups if name == lang and o != source]
        above = [(t, p[lang, source, t] - q[lang, t]) for t in kept[lang] if n[lang, source, t] and p[lang, source, t] > q[lang, t]]
        for part, rows, most in (("pair", pairs, None), ("term", above, ranks)):
            rows.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(rows[:most])]
    return sorted(out)


def report(df, **settings):
    return sorted(tuple(r) for r in D.audit_sources(df, **settings).collect())


def some_docs(seed, rows=400):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeÉß漢Z", k=rng.choice([1, 2, 4, 8, 9, 15, 17, 40]))) for _ in range(60)]
    docs = []
    for _ in range(rows):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "ß", None])
        text = rng.choice(["-", " ", "1"]).join(rng.choices(words, k=rng.randint(0, 30)))
        docs.append((lang, source, rng.choice([text, text, text.upper(), None])))
    return docs + [("xx", "lonely", "once"), ("xx", "other", None)]


@pytest.mark.parametrize("least, block", [(1, 2_000), (30, 7), (120, 3), (10_000, 5)])
def test_report_equals_brute_force(spark, monkeypatch, least, block):
    monkeypatch.setattr(D, "BLOCK_TERMS", block)
    monkeypatch.setattr(D, "COMPARED", 10)
    monkeypatch.setattr(D, "CHUNK_BYTES", 2_000)
    docs = some_docs(least)
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(6)
    assert report(df, least=least, term_ranks=9) == brute(docs, least, 9)


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("term", F.lit("old")).withColumn("block", F.lit(1))
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert report(docs, least=2) == brute(rows, 2)
    assert report(docs) == brute(rows, 30)
    assert D.audit_sources(empty_docs(spark)).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    values = [(9 * 10**18, 10**10), (5, 2), (0, 1)]
    df = spark.createDataFrame([(n, 9 * 10**18, v) for n, v in values], "n bigint, total bigint, v bigint")
    got = [r[0] for r in df.select(D.share(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (9 * 10**18 + 5 * v) for n, v in values]


def test_packed_terms_sort_as_bytes_and_count_by_group():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abXYéß漢 -.0\n", k=rng.randint(0, 300))) for _ in range(200)]
    texts += ["a" * 17 + " " + "b" * 40 + " " + "a" * 17, "", "x" * 8 + " " + "x" * 9 + " " + "y" * 16 + " y" * 3, "é" * 5000 + " " + "a" * 100_000]
    groups = np.array([rng.randint(0, 4) for _ in texts])
    n, held = Counter(), Counter()
    for text, group in zip(texts, groups.tolist(), strict=True):
        n.update((group, t) for t in terms_of(text))
        held.update((group, t) for t in set(terms_of(text)))
    got, seen = {}, {}
    for group, terms, count, documents in P.count_terms([t.encode() for t in texts], groups):
        assert terms == sorted(terms)
        for g, t, c, d in zip(group.tolist(), terms, count.tolist(), documents.tolist(), strict=True):
            assert (g, t.decode()) not in got
            got[g, t.decode()], seen[g, t.decode()] = c, d
    assert got == n and seen == held


def test_radix_order_is_stable():
    rng = np.random.default_rng(2)
    for high in (3, 2**17, 2**63):
        keys = [rng.integers(0, high, 5000, dtype=np.uint64), rng.integers(0, 4, 5000, dtype=np.uint64)]
        assert np.array_equal(P.radix_order(keys), np.lexsort((keys[1], keys[0])))
