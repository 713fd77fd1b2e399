import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_rows import awkward_docs, empty_docs, prose
from tokenizers import Tokenizer

from tallywright.llm import packing
from tallywright.llm.queries import QUERIES


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, ids_of, limit=1024):
    """Every piece holds its tokens, every document is whole, every sequence gapless; returns their number."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids_of)
    for doc_id, own in pieces.items():
        for ids in [ids_of[doc_id]]:
            at = 0
            for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
                assert (r.piece, r.start) == (k, at)
                part = np.array(ids[at : at + r.length], dtype="<u4")
                assert zlib.crc32(part.tobytes()) == r.ids_crc32
                at += r.length
            assert at == len(ids)
            assert len(own) == -(-len(ids) // limit)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit
    return len(places)


def test_encoder_equals_the_tokenizers_library(spark, reference):
    encode = packing.encoder(packing.TOKENIZER)
    rng = random.Random(5)
    blocks = [range(32, 127), range(0, 0x250), range(0x370, 0x700), range(0x900, 0xE00), range(0x2000, 0x2100),
              range(0x3000, 0x3200), range(0x4E00, 0x4F00), range(0xAC00, 0xAD00), range(0x1F300, 0x1F700)]
    texts = ["", " ", "\n\n x", "it's WE'LL 'd", "a<|endoftext|>b <|endoftext|>", "\u0085  　x", "12½²٣"]
    texts += ["".join(chr(rng.choice(b)) for b in rng.choices(blocks, k=60)) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert [*encode(text), 2] == reference(text), text


def test_query_over_whole_texts(spark, reference):
    sf = "/root/testdata/sf0.01"
    ids = {r.doc_id: reference(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    used = check(QUERIES["op4_best_fit_packing"](spark, sf).collect(), ids)
    assert used <= 1.01 * sum(map(len, ids.values())) / 1024 + 1


def test_awkward_rows(spark, reference):
    docs = awkward_docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"]).repartition(7)
    check(packing.pack_documents(docs).collect(), {r.doc_id: reference(r.text) for r in docs.collect()})
    again = awkward_docs(spark)
    assert packing.pack_documents(again).filter("piece = 0").count() == again.count()
    assert packing.pack_documents(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("fan_in", [2, 16])
def test_underfull_bins_of_many_tasks_are_merged(spark, reference, fan_in):
    rows = [(k, prose(20 + k % 50, k)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40, "doc_id")
    ids = {k: reference(t) for k, t in rows}
    used = check(packing.pack_documents(docs, fan_in=fan_in).collect(), ids)
    # 40 tasks of 3 documents: bins travel whole, so some room stays
    assert used <= sum(map(len, ids.values())) / 1024 * 1.25 + 1


def test_best_fit_against_a_plain_one():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 200))]
        bins, offsets, fills = packing.best_fit(sizes, 100)
        plain = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [f for f in plain if f + sizes[i] <= 100]
            if fits:
                plain[plain.index(max(fits))] += sizes[i]
            else:
                plain.append(sizes[i])
        assert sorted(plain) == sorted(fills)
        for b, fill in enumerate(fills):
            own = sorted((offsets[i], sizes[i]) for i in range(len(sizes)) if bins[i] == b)
            assert [o for o, _ in own] == [sum(s for _, s in own[:k]) for k in range(len(own))]
            assert sum(s for _, s in own) == fill <= 100


def test_a_group_hands_up_no_more_than_its_bound():
    import pandas as pd

    frame = pd.DataFrame({"bin": range(500), "fill": [600] * 499 + [300], "node": 0,
                          "members": [[{"bin": k, "shift": 0}] for k in range(500)], "open": True})
    out = packing.merge_group(frame, 1024, 8, hosts=16)
    assert out["open"].sum() <= 17 and out["fill"].sum() == frame["fill"].sum()
