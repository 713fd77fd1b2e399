import zlib

import numpy as np
import pytest
from llm_rows import awkward_docs, empty_docs, prose
from pyspark.sql import functions as F

import corpus_pipeline as P
from tallywright.llm import packing, secrets
from tallywright.llm.queries import QUERIES
from test_llm_mixing import brute as brute_mix
from test_llm_packing import check
from test_llm_simhash import brute_components, brute_mark


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small table with planted copies, secrets and a text without letters."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = prose(200, 77)
    planted = [(10_000 + k, base + (" x" if k % 2 else ""), "en", "src0", 1) for k in range(6)]
    planted += [(10_100, "42 17 !!", "en", "src0", 8), (10_101, base[::-1] + " token = \"0123456789abcdef01234567\" end", "en", "src1", 1)]
    out = tmp_path_factory.mktemp("docs")
    docs.unionByName(spark.createDataFrame(planted, docs.schema)).write.parquet(str(out / "documents.parquet"))
    return str(out)


def test_stage_list():
    assert [name for name, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "secret_scans", "source_mix", "best_fit_packing"]
    assert P.ORACLE_SQL is None and QUERIES["pipeline"] is P.run


def test_run_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    kept = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    groups = brute_components([(r.doc_id, brute_mark(r.text)) for r in kept])
    kept = [r for r in kept if groups[brute_mark(r.text)] == r.doc_id]
    masked = {}
    for r in secrets.scan_secrets(spark.createDataFrame(kept, rows[0].__fields__)).collect():
        text, out, at = r.text, "", 0
        for s in r.secret_spans:
            if s.start >= at:
                out, at = out + text[at : s.start] + "[secret]", s.end
            at = max(at, s.end)
        masked[r.doc_id] = out + text[at:]
    slim = [(r.doc_id, "all", r.lang, r.source, len(masked[r.doc_id].encode().split())) for r in kept]
    taken = {d for d, _ in brute_mix(slim, P.MIX_WEIGHTS, P.MIX_SHARE, 1, P.MIX_SEED)}
    encode = packing.encoder(packing.TOKENIZER)
    ids = {d: [*encode(masked[d]), 2] for d in taken}
    got = P.run(spark, folder).collect()
    assert check(got, ids) <= 1.02 * sum(map(len, ids.values())) / 1024 + 1
    one = next(r for r in got if r.piece == 0)
    assert one.ids_crc32 == zlib.crc32(np.array(ids[one.doc_id][: one.length], dtype="<u4").tobytes())


def test_decisions_of_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = P.keep_known_languages(spark, docs, folder)
    assert known.columns == docs.columns
    gone = {r.doc_id for r in docs.join(known, "doc_id", "left_anti").collect()}
    assert gone == {10_100}
    single = P.drop_near_copies(spark, docs, folder)
    assert single.columns == docs.columns
    marks = [(r.doc_id, brute_mark(r.text)) for r in docs.collect()]
    groups = brute_components(marks)
    assert {r.doc_id for r in single.collect()} == {i for i, m in marks if groups[m] == i}
    # the two planted texts differ in five bits, so each keeps its first copy
    assert sorted(r.doc_id for r in single.filter("doc_id between 10000 and 10005").collect()) == [10_000, 10_001]
    masked = P.mask_secrets(spark, docs, folder)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    text = masked.filter("doc_id = 10101").first()
    assert text.text.endswith("[secret]\" end") and text.n_chars == len(text.text)
    mixed = P.mix_sources(spark, docs, folder)
    assert mixed.columns == docs.columns and 0 < mixed.count() < docs.count()


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("lang_pred", F.lit("old")).withColumn("spans", F.lit("old"))
    docs = docs.withColumn("score", F.lit(7.0)).withColumn("secret_spans", F.lit("old")).withColumn("__found", F.lit(1))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert 0 < out.count() <= docs.count()
        assert out.filter("lang_pred != 'old' or spans != 'old' or score != 7 or secret_spans != 'old'").count() == 0, name
        assert stage(spark, docs.limit(0), "").count() == 0
    assert P.pack_sequences(spark, empty_docs(spark), "").count() == 0


def test_one_row_stays_of_rows_that_share_an_id(spark):
    docs = awkward_docs(spark).filter("doc_id = 7 or doc_id = 8")
    docs = docs.union(docs).union(docs.withColumn("mark", F.lit("a")))
    out = P.drop_near_copies(spark, docs, "").collect()
    assert sorted((r.doc_id, r.mark) for r in out) == [(7, "a"), (8, "a")]
