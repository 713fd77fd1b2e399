import random

import numpy as np
from llm_rows import WORD, awkward_docs, empty_docs, prose

from tallywright.llm import rolling, substrings


def brute(docs, window):
    """(n_words, kept text) per row of (id, text); rows that share id and text are one document."""
    first = {}
    words = [WORD.findall(text or "") for _, text in docs]
    for (doc_id, _), own in zip(docs, words, strict=True):
        if doc_id is not None:
            for i in range(len(own) - window + 1):
                key = tuple(own[i : i + window])
                first[key] = min(first.get(key, (doc_id, i)), (doc_id, i))
    out = []
    for (doc_id, _), own in zip(docs, words, strict=True):
        gone = set()
        if doc_id is not None:
            for i in range(len(own) - window + 1):
                if first[tuple(own[i : i + window])] != (doc_id, i):
                    gone.update(range(i, i + window))
        out.append((doc_id, len(own), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return sorted(out, key=str)


def run(spark, docs, window, parts=4):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    rows = substrings.remove_repeats(df, window=window).collect()
    for r in rows:
        spans = [(s.start, s.end) for s in r.intervals]
        assert all(a < b for a, b in spans)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
        assert len(WORD.findall(r.kept)) == r.n_words - sum(b - a for a, b in spans)
    return sorted(((r.doc_id, r.n_words, r.kept) for r in rows), key=str)


def test_shared_passages_copies_and_loops(spark):
    rng = random.Random(4)
    passages = [prose(30, 100 + k) for k in range(5)]
    docs = []
    for k in range(80):
        parts = [prose(rng.randint(0, 40), 500 + k)] + rng.choices(passages, k=rng.randint(0, 3)) + [prose(5, 900 + k)]
        docs.append((rng.choice([k, -k]), " ".join(parts)))
    docs += [(1000, "a b c " * 50), (1001, docs[3][1]), (1002, docs[3][1] + " x"), (5, docs[3][1])]
    docs = list({d: (d, t) for d, t in docs}.values())
    for window in (1, 3, 20):
        assert run(spark, docs, window) == brute(docs, window)


def test_awkward_rows(spark):
    docs = [(r.doc_id, r.text) for r in awkward_docs(spark).collect()]
    assert run(spark, docs, 20) == brute(docs, 20)
    assert substrings.remove_repeats(empty_docs(spark)).count() == 0


def test_places_survive_packing():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50, 5000):
        docs = np.sort(rng.integers(-(2**40), 2**40, max(1, n // 3)))[rng.integers(0, max(1, n // 3), n)]
        starts = rng.integers(0, 2**30, n)
        d, s = substrings.unpack_places(substrings.pack_places(docs, starts), n)
        assert np.array_equal(d, docs) and np.array_equal(s, starts)
        pairs = np.stack([docs, starts, docs[::-1], starts[::-1]], axis=1)
        back = substrings.unpack_pairs(substrings.pack_pairs(pairs), n)
        assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, pairs.tolist()))


def test_word_values_tell_words_apart(monkeypatch):
    text = prose(3000, 8).encode() + "\x0b é ü  x\ty\x1cz ".encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends = rolling.word_spans(data)
    words = [text[a:b] for a, b in zip(starts, ends, strict=True)]
    assert words == text.split()
    values = rolling.word_values(data, starts, ends)
    monkeypatch.setattr(rolling, "PIECE", 64)
    assert np.array_equal(values, rolling.word_values(data, starts, ends))
    both = list(map(tuple, values.T.tolist()))
    assert len(set(both)) == len(set(words))
    assert all(len({both[i] for i in range(len(words)) if words[i] == w}) == 1 for w in set(words[:50]))


def test_prefix_sums_roll_to_the_polynomial():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2**31 - 20, (2, 300), dtype=np.uint64)
    for width in (1, 20):
        got = rolling.window_hashes(values, width)
        for i in range(0, 300 - width + 1, 37):
            halves = [sum(int(values[k, i + j]) * pow(b, j, p) for j in range(width)) % p for k, (b, p) in enumerate(zip(rolling.WORD_BASES, rolling.PRIMES, strict=True))]
            assert got[i] == rolling.mixed(np.array([halves[0] << 31 | halves[1]], dtype=np.uint64))[0]


def thue_morse(bits, flip=0):
    return "".join("ab"[bin(i).count("1") + flip & 1] for i in range(1 << bits))


def test_words_that_collide_modulo_powers_of_two(spark):
    before, after = prose(10, 1), prose(10, 2)
    docs = [(k, f"{before} {thue_morse(10, k % 2)} {after}") for k in range(4)]
    got = run(spark, docs, 20)
    assert got == brute(docs, 20)
    assert [len(WORD.findall(kept)) for _, _, kept in got] == [21, 21, 0, 0]


def test_equal_hashes_of_other_words_cut_nothing(spark, monkeypatch):
    """Hashes of a few bits: most windows meet others that are not equal."""
    from pyspark import cloudpickle

    real = substrings.windows_of

    def coarse(docs, window):
        hashes, ids, starts = real(docs, window)
        return hashes & np.uint64(0x3F << 58 | 0x1F), ids, starts

    monkeypatch.setattr(substrings, "windows_of", coarse)
    cloudpickle.register_pickle_by_value(substrings)  # so that the tasks use it too
    rng = random.Random(4)
    passage = prose(26, 50)
    docs = [(k, " ".join([prose(rng.randint(5, 30), k), *[passage] * rng.randint(0, 2), prose(4, 900 + k)])) for k in range(40)]
    try:
        assert run(spark, docs, 20) == brute(docs, 20)
        assert run(spark, docs, 3) == brute(docs, 3)
    finally:
        cloudpickle.unregister_pickle_by_value(substrings)


def test_many_groups_and_strided_ids(spark, monkeypatch):
    rng = random.Random(9)
    passages = [prose(30, 100 + k) for k in range(3)]
    docs = [(64 * k, " ".join([prose(rng.randint(0, 40), 500 + k), *rng.choices(passages, k=2)])) for k in range(60)]
    expected = brute(docs, 20)
    for settings in ({"PART_BYTES": 500}, {"GROUP_BYTES": 4, "PART_BYTES": 300, "FAN": 256}, {"CHUNK_BYTES": 3_000, "GROUP_BYTES": 8, "PART_BYTES": 60, "FAN": 256}):
        for name, value in settings.items():
            monkeypatch.setattr(substrings, name, value)
        assert run(spark, docs, 20) == expected
    own = substrings.part_of(np.arange(0, 64 * 6400, 64), 64)
    assert np.bincount(own, minlength=64).min() > 60
    many = substrings.remove_repeats(spark.createDataFrame([(None, t) for _, t in docs], "doc_id bigint, text string"))
    assert many.filter("size(intervals) > 0").count() == 0 and many.count() == len(docs)


def test_rows_that_share_a_key(spark):
    docs = [(1, prose(40, 1)), (2, prose(40, 1) + " x"), (2, prose(40, 5)), (3, prose(40, 5)), (3, None)]
    rows = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(rows) == len(docs)
    got = sorted((r.doc_id, r.n_words, len(WORD.findall(r.kept))) for r in rows)
    assert got[0] == (1, 40, 40) and got[-1] == (3, 40, 0) and got[-2] == (3, 0, 0)
