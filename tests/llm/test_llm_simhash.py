import numpy as np
import xxhash
from llm_rows import awkward_docs, empty_docs, prose

from tallywright.llm import components, simhash
from tallywright.llm.queries import QUERIES
from tallywright.session import materialize


def brute_mark(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 3:
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    else:
        shingles = [b" ".join(words)] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(marks):
    """Smallest id reachable over links, for (id, mark) pairs."""
    least = {m: min((i for i, o in marks if o == m and i is not None), default=None) for _, m in marks}
    distinct = sorted(least)
    seen, out = set(), {}
    for m in distinct:
        if m in seen:
            continue
        group, todo = {m}, [m]
        while todo:
            x = todo.pop()
            for y in distinct:
                if y not in group and (x ^ y).bit_count() <= 2:
                    group.add(y)
                    todo.append(y)
        seen |= group
        low = min((least[g] for g in group if least[g] is not None), default=None)
        out.update(dict.fromkeys(group, low))
    return out


def test_fingerprints_equal_brute_force(monkeypatch):
    texts = [None, "", "One", "one TWO", "A b c d", "Ünï ünï x", prose(500, 1), prose(3, 2)]
    assert [int(x) for x in simhash.fingerprints(texts)] == [brute_mark(t) for t in texts]
    monkeypatch.setattr(simhash, "SUM_SHINGLES", 7)
    assert [int(x) for x in simhash.fingerprints(texts)] == [brute_mark(t) for t in texts]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    marks = {i: brute_mark(t) for i, t in texts.items()}
    expected = brute_components(list(marks.items()))
    rows = QUERIES["op2_simhash"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fingerprint == f"{marks[r.doc_id]:016x}"
        assert r.component_id == expected[marks[r.doc_id]]


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    expected = brute_components([(r.doc_id, brute_mark(r.text)) for r in docs.collect()])
    rows = simhash.cluster(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.component_id == expected[r.mark % 2**64]
    assert simhash.cluster(empty_docs(spark)).count() == 0


def test_tiles_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    marks = list(base)
    for k in range(400):  # chains of near marks, and marks at distance 3 from one another
        bits = rng.choice(64, rng.integers(1, 4), replace=False)
        mark = int(marks[rng.integers(0, len(marks))])
        for b in bits:
            mark ^= 1 << int(b)
        marks.append(np.uint64(mark))
    marks = sorted({int(m) for m in marks} | {0, 2**64 - 1, 1, 3})
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    monkeypatch.setattr(simhash, "TILE", 16)
    found = materialize(simhash.links(spark.createDataFrame([(m,) for m in signed], "mark bigint")), "links")
    edges = found.collect()
    assert len(edges) < 21 * len(marks)
    assert all(((e.a ^ e.b) % 2**64).bit_count() <= 2 for e in edges)
    roots = {r.node % 2**64: r.root for r in components.connected(found).collect()}
    expected = brute_components([(m, m) for m in marks])
    for m in marks:
        for n in marks:
            same = roots.get(m, m) == roots.get(n, n) if m in roots and n in roots else m == n
            assert same == (expected[m] == expected[n])


def test_components_of_a_star_a_chain_and_a_loop(spark):
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(300)} == {0}
    assert {got[1000 + k] for k in range(41)} == {1000}
    assert {got[5000], got[5001]} == {5000}
