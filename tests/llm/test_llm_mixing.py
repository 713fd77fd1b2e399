import hashlib
from collections import defaultdict

import pytest
from llm_rows import WORD, awkward_docs, empty_docs
from pyspark.sql import functions as F

from tallywright.llm import mixing
from tallywright.llm.text_units import words_of


def fill(children, budget):
    """Budgets of (name, cap, weight) by rounds: whoever cannot use the share takes the cap."""
    out, live, left = {}, list(children), budget
    while live:
        total = sum(w for _, _, w in live)
        full = [c for c in live if c[1] * total <= c[2] * left]
        if not full:
            break
        for name, cap, _ in full:
            out[name] = cap
        left -= sum(c[1] for c in full)
        live = [c for c in live if c not in full]
    total = sum(w for _, _, w in live)
    out.update({name: w * left // total for name, _, w in live})
    return out


def brute(rows, weights, share, epochs, seed):
    """(id, epoch) pairs by recursion over the tree."""
    leaves = defaultdict(list)
    for doc_id, domain, lang, source, tokens in rows:
        leaves[(domain, lang, source)].append((doc_id, tokens))
    size = {leaf: sum(t for _, t in docs) for leaf, docs in leaves.items()}
    weight = lambda path: weights.get(path, 1)
    size_ok = {k: v for k, v in size.items() if v and all(weight(k[: n + 1]) for n in range(3))}

    def go(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        names = {k[: len(prefix) + 1] for k in size_ok if k[: len(prefix)] == prefix}
        caps = [(n, sum(epochs * v for k, v in size_ok.items() if k[: len(n)] == n), weight(n)) for n in names]
        out = {}
        for name, given in fill(caps, budget).items():
            out |= go(name, given)
        return out

    taken = []
    for leaf, budget in go((), int(sum(size.values()) * share)).items():
        whole, rest = divmod(budget, size[leaf])
        for e in range(whole):
            taken += [(d, e) for d, t in leaves[leaf]]
        key = lambda d: hashlib.md5(f"{seed}:{whole}:{'null' if d is None else d}".encode()).hexdigest()
        groups = defaultdict(list)
        for d, t in leaves[leaf]:
            groups[key(d)].append((d, t))
        for k in sorted(groups):
            rest -= sum(t for _, t in groups[k])
            if rest < 0:
                break
            taken += [(d, whole) for d, _ in groups[k]]
    return sorted(taken, key=str)


WEIGHTS = {("a",): 5, ("b",): 1, ("a", "en"): 3, ("a", "fr"): 1, ("b", "de"): 0}


@pytest.mark.parametrize("share, epochs", [(0.3, 1), (0.8, 1), (1.0, 3), (2.5, 2), (0.0, 1)])
def test_mix_equals_brute_force(spark, share, epochs):
    rows = []
    for k in range(600):
        domain = "a" if k % 3 else "b"
        lang = [None, "en", "fr", "de"][k % 4]
        rows.append((k, domain, lang, "hot" if k % 2 else f"s{k % 5}", (k * 7919) % 97))
    df = spark.createDataFrame(rows, "doc_id bigint, domain string, lang string, source string, tokens bigint")
    mix = mixing.plan_mix(df, WEIGHTS, share=share, max_epochs=epochs, seed=9)
    got = sorted(((r.doc_id, r.epoch) for r in mixing.take(df, mix, F.col("domain")).collect()), key=str)
    # rows without tokens lie anywhere in the order of their leaf
    own = {r[0]: r[4] for r in rows}
    assert [g for g in got if own[g[0]]] == [b for b in brute(rows, WEIGHTS, share, epochs, 9) if own[b[0]]]
    used = sum(own[d] for d, _ in got)
    assert used <= share * sum(own.values())


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("epoch", F.lit("old")).withColumn("__domain", F.lit("x"))
    rows = mixing.slim(docs, "doc_id", F.lit("all"), F.size(words_of(F.col("text"))))
    mix = mixing.plan_mix(rows, {}, share=1.0)
    out = mixing.take(docs, mix, F.lit("all"))
    assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes)["epoch"] == "int"
    worded = sum(1 for r in docs.collect() if WORD.search(r.text or ""))
    assert worded <= out.count() <= docs.count()
    empty = mixing.slim(empty_docs(spark), "doc_id", F.lit("all"), F.lit(1))
    assert mixing.take(empty_docs(spark), mixing.plan_mix(empty, {}, share=0.5), F.lit("all")).count() == 0
    for wrong in ({"share": 0.5, "budget": 3}, {}):
        with pytest.raises(ValueError):
            mixing.plan_mix(rows, {}, **wrong)
