import random
import re

import pytest
from llm_rows import awkward_docs, empty_docs, prose
from pyspark.sql import functions as F

from tallywright.llm import licenses as L
from tallywright.llm.oracles import ORACLES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(L.UPPER, L.LOWER)


def brute(text, containment, templates=L.TEMPLATES):
    """The digest of one text, every block held against every template."""
    words = WORD.findall((text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in L.PHRASES.items():
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        base |= {label} if found else set()
    labels, score = set(base), 1.0 if base else 0.0
    starts = [0]
    while starts[-1] + L.BLOCK_WORDS < len(words):
        starts.append(starts[-1] + L.STEP_WORDS)
    for start in starts:
        block = set(words[start : start + L.BLOCK_WORDS])
        for t in L.cut_templates(templates):
            shared = len(block & set(t.words))
            if shared >= t.overlap(containment):
                labels.add(t.label)
                score = max(score, shared / len(t.words))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def digests(df, key="doc_id"):
    rows = df.collect()
    return sorted(((r[key], *r[1:]) for r in rows), key=str)


def planted():
    rng = random.Random(3)
    docs = []
    for k in range(120):
        words = prose(rng.randint(0, 150), k).split()
        for label, text in rng.choices(L.TEMPLATES, k=rng.randint(0, 2)):
            notice = text.split()
            for _ in range(rng.randint(0, 3)):  # words lost, or others put between
                at = rng.randrange(len(notice))
                if rng.random() < 0.5:
                    notice[at : at + 1] = []
                else:
                    notice.insert(at, "other")
            at = rng.randint(0, len(words))
            words[at:at] = notice
        docs.append((k, " ".join(words)))
    phrases = ["CC-BY 4.0", "cc by cc by", "General, Public\nLICENSE", "all rights\x00reserved", "all rights  reservéd", "geneıral public license",
               "cc", "by cc", "K cc by", "general public", ""]
    return docs + [(1000 + k, t) for k, t in enumerate(phrases)]


@pytest.mark.parametrize("containment", [0.5, 0.9, 1.0])
def test_join_equals_brute_force(spark, containment):
    docs = planted()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = digests(L.scan_licenses(df, containment=containment))
    expected = sorted(((k, *brute(t, containment)) for k, t in docs), key=str)
    assert got == expected
    assert sum(bool(row[-2]) for row in expected) > 40


def test_long_templates_are_cut_into_pieces(spark):
    text = prose(100, 5)
    templates = [("own", text)]
    assert len(L.cut_templates(templates)) == 4
    docs = [(1, prose(70, 6) + " " + text), (2, " ".join(text.split()[30:80])), (3, prose(200, 9)), (4, text.upper())]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = digests(L.scan_licenses(df, templates=templates, phrases={}))
    assert got == [(k, *brute(t, L.CONTAINMENT, templates)) for k, t in docs]
    assert [bool(r[-2]) for r in got] == [True, True, False, True]


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("labels", F.lit("old")).withColumn("row", F.lit(1)).withColumn("__text", F.lit(1))
    expected = sorted(((r.doc_id, *brute(r.text, L.CONTAINMENT)) for r in docs.collect()), key=str)
    assert digests(L.scan_licenses(docs)) == expected
    assert digests(L.scan_licenses(docs.withColumnRenamed("doc_id", "Words"), key="Words"), "Words") == expected
    assert L.scan_licenses(empty_docs(spark)).count() == 0
    long = "all rights reserved " * 30_000 + L.TEMPLATES[1][1]
    row = L.scan_licenses(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).first()
    assert (row.n_base, row.first_word, row.last_word, row.labels) == (30_000, 0, 89_997, "apache-2.0,reserved")


def test_filters_and_bounds(spark):
    with pytest.raises(ValueError):
        L.cut_templates([("x", " -- ")])
    with pytest.raises(ValueError):
        L.scan_licenses(empty_docs(spark), containment=0)
    many = [("x", " ".join(f"w{k}a{j}" for j in range(1000))) for k in range(21)]
    with pytest.raises(ValueError):
        L.cut_templates(many)
    assert L.Template("x", tuple("abcdefghij")).overlap(0.9) == 9  # 0.9 * 10 is not rounded up to 10
    plan = L.scan_licenses(awkward_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_sql_has_every_template():
    assert all(label in ORACLES["op11_license_scans"] for label, _ in L.TEMPLATES)
