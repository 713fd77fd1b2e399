"""Removal of repeated passages: rolling hashes of all word windows, matched in Spark, then checked.

Every window of a document is hashed (:mod:`rolling`). A task groups the windows of some documents
by the leading bits of the hash, keeps the first of equal ones and pairs each later one with it,
and sends each group as one packed row. Groups of the same bits meet in one task, where equal
hashes of different tasks are ordered by document and place: all but the first are paired with it.
Neighbouring pairs of the same two documents merge into runs, which are few.

Equal hashes are not taken for equal words: each run's words are digested (128 bits) on both of its
sides, while the documents are cut by the runs, and the two digests are compared. Windows of runs
that differ, and all windows that were paired with them, are told apart by their words, and their
documents are cut again.

A passage that a third of all documents share sends one window per task, not one per document, so
no group is larger than its share of the hash space plus the number of tasks. Windows travel as
about nine bytes each; where there are more groups than a task can fill rows for, they are dealt in
two steps.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import rolling
from tallywright.session import materialize

WINDOW = 20
#: Bytes of text whose windows a task packs at once, that one hash group may stand for, and that
#: one group of documents may hold when passages are cut out.
CHUNK_BYTES, GROUP_BYTES, PART_BYTES = 6 << 20, 6 << 20, 16 << 20
#: Hash groups are a power of two of at least this number, so that 7 bytes hold the rest; beyond
#: ``FAN`` groups they are dealt in two steps, so that rows stay filled.
LEAST_GROUPS, FAN = 256, 4096
PACKED = "bucket long, dealer long, n long, hashes binary, places binary, later_n long, later binary"
PAIRS = "part long, dealer long, n long, pairs binary"
RUNS = "doc long, start long, windows long, first_doc long, first_start long"
CUT = (
    "row long, n_words long, intervals array<struct<start:int,end:int>>, kept string, "
    "first_doc long, first_start long, words long, digest binary"
)


def _planes(*columns: np.ndarray) -> bytes:
    """Columns as compressed differences, byte by byte."""
    raw = b"".join(
        np.ascontiguousarray(np.diff(c, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns
    )
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _columns(packed: bytes, n: int, width: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=8 * width * n or 1)
    data = np.frombuffer(raw, np.uint8).reshape(width, 8, n)
    return [np.cumsum(np.ascontiguousarray(plane.T).view("<i8").reshape(n)) for plane in data]


def pack_places(docs: np.ndarray, starts: np.ndarray) -> bytes:
    """Document ids and window starts; dense if sorted."""
    return _planes(docs, starts)


def unpack_places(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(_columns(packed, n, 2))


def pack_pairs(pairs: np.ndarray) -> bytes:
    """Rows (doc, start, first doc, first start); sorted, since neighbours mostly keep their distance."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return _planes(pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3] - pairs[:, 1])


def unpack_pairs(packed: bytes, n: int) -> np.ndarray:
    doc, start, first_doc, step = _columns(packed, n, 4)
    return np.stack([doc, start, first_doc, start + step], axis=1)


def windows_of(docs: list[tuple[int, bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document id and start of every window of some documents, in (document, start) order."""
    docs = sorted(docs, key=lambda d: d[0])
    data = np.frombuffer(b"\n".join(text for _, text in docs), dtype=np.uint8)
    bounds = np.cumsum([len(text) + 1 for _, text in docs])
    starts, ends = rolling.word_spans(data)
    owner = np.searchsorted(bounds, starts, side="right")
    hashes = rolling.window_hashes(rolling.word_values(data, starts, ends), window)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[window - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    first_word = np.searchsorted(owner, np.arange(len(docs)), side="left")
    owner = owner[inside]
    ids = np.array([doc_id for doc_id, _ in docs], dtype=np.int64)
    return hashes[inside], ids[owner], inside - first_word[owner]


def later_ones(hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of first windows; rows of later ones at another place than the first of their hash; those firsts."""
    order = np.argsort(hashes, kind="stable")
    again = np.zeros(len(order), dtype=bool)
    again[1:] = hashes[order[1:]] == hashes[order[:-1]]
    none = np.zeros(0, dtype=np.int64)
    if not again.any():
        return np.arange(len(order)), none, none
    group = again.copy()
    group[:-1] |= again[1:]
    rows = order[group]
    rows = rows[np.lexsort((starts[rows], docs[rows], hashes[rows]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = hashes[rows[1:]] != hashes[rows[:-1]]
    head = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
    other = (docs[rows] != docs[head]) | (starts[rows] != starts[head])
    return np.sort(np.concatenate([order[~group], rows[new]])), rows[other], head[other]


def paired(docs: np.ndarray, starts: np.ndarray, later: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.stack([docs[later], starts[later], docs[first], starts[first]], axis=1)


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each key."""
    order = np.argsort(keys, kind="stable")
    names, at = np.unique(keys[order], return_index=True)
    return zip(names.tolist(), np.split(order, at[1:]), strict=True) if len(keys) else iter(())


def _packed_rows(
    hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray, pairs: np.ndarray, pair_hashes: np.ndarray, bits: int, dealer: int
) -> pa.Table:
    """Windows and known pairs as one row for each value of the leading bits of the hash."""
    shift = np.uint64(64 - bits)
    low = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
    more = dict(_split((pair_hashes >> shift).astype(np.int64)))
    out = []
    for name, rows in _split((hashes >> shift).astype(np.int64)):
        own = pairs[more[name]] if name in more else pairs[:0]
        out.append((name, dealer, len(rows), low[rows].tobytes(), pack_places(docs[rows], starts[rows]),
                    len(own), pack_pairs(own) if len(own) else b""))
    names = ["bucket", "dealer", "n", "hashes", "places", "later_n", "later"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _windows(rows: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, documents and starts of packed rows of one length of leading bits."""
    hashes, docs, starts = [], [], []
    for row in rows.select(["bucket", "n", "hashes", "places"]).to_pylist():
        wide = np.zeros((row["n"], 8), dtype=np.uint8)
        wide[:, :7] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, 7)
        hashes.append(wide.view("<u8").reshape(-1).astype(np.uint64) | np.uint64(row["bucket"] >> (bits - 8) << 56))
        d, s = unpack_places(row["places"], row["n"])
        docs.append(d)
        starts.append(s)
    return np.concatenate(hashes), np.concatenate(docs), np.concatenate(starts)


def _pairs(rows: pa.Table, n: str, packed: str) -> np.ndarray:
    found = [unpack_pairs(p, k) for k, p in zip(rows[n].to_pylist(), rows[packed].to_pylist(), strict=True) if k]
    return np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)


def packer(window: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task that turns documents (id, text bytes) into packed hash groups."""

    def pack(docs: list[tuple[int, bytes]]) -> list[pa.RecordBatch]:
        hashes, ids, starts = windows_of(docs, window)
        first, later, head = later_ones(hashes, ids, starts)
        pairs = paired(ids, starts, later, head)
        dealer = xxhash.xxh32_intdigest(str(docs[0][0]))
        return _packed_rows(hashes[first], ids[first], starts[first], pairs, hashes[later], bits, dealer).to_batches()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, bytes]] = []
        size = 0
        for batch in batches:
            for doc in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc = (doc[0], doc[1].as_py())
                if waiting and size + len(doc[1]) > CHUNK_BYTES:
                    yield from pack(waiting)
                    waiting, size = [], 0
                waiting.append(doc)
                size += len(doc[1])
        if waiting:
            yield from pack(waiting)

    return task


def redealer(old: int, new: int) -> Callable[[pa.Table], pa.Table]:
    """The task that deals packed groups of ``old`` leading bits by ``new`` ones.

    It pairs equal hashes on the way, as the first task does.
    """

    def deal(rows: pa.Table) -> pa.Table:
        hashes, docs, starts = _windows(rows, old)
        first, later, head = later_ones(hashes, docs, starts)
        known = _pairs(rows, "later_n", "later")
        pairs = np.concatenate([paired(docs, starts, later, head), known])
        # known pairs need no hash any more: they ride along with some window of this group
        riding = np.concatenate([hashes[later], np.full(len(known), hashes[0], dtype=np.uint64)])
        return _packed_rows(hashes[first], docs[first], starts[first], pairs, riding, new, rows["dealer"][0].as_py())

    return deal


def matcher(parts: int, deal: int) -> Callable[[pa.Table], pa.Table]:
    """The task that pairs equal hashes of one group, dealt by the part of their document."""

    def match(rows: pa.Table) -> pa.Table:
        bits = LEAST_GROUPS.bit_length() - 1  # all rows have one bucket, its low bits do not matter here
        hashes, docs, starts = _windows(rows.set_column(0, "bucket", pa.array(np.zeros(rows.num_rows, np.int64))), bits)
        _, later, head = later_ones(hashes, docs, starts)
        pairs = np.concatenate([paired(docs, starts, later, head), _pairs(rows, "later_n", "later")])
        return _by_part(pairs, parts, deal, rows["bucket"][0].as_py())

    return match


def part_dealer(parts: int) -> Callable[[pa.Table], pa.Table]:
    """The task that deals the pairs of some parts to each of them."""
    return lambda rows: _by_part(_pairs(rows, "n", "pairs"), parts, parts, rows["dealer"][0].as_py())


def _by_part(pairs: np.ndarray, parts: int, deal: int, dealer: int) -> pa.Table:
    """One row for each part, or for each remainder of the part's number if there are more than ``deal``."""
    out = [(int(p), dealer, len(r), pack_pairs(pairs[r])) for p, r in _split(part_of(pairs[:, 0], parts) % deal)]
    columns = list(zip(*out, strict=True)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "dealer", "n", "pairs"])


def part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    """The part of each document id: its bits mixed, so that ids with a common stride spread."""
    return (rolling.mixed(docs.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def run_former(rows: pa.Table) -> pa.Table:
    """The runs of the pairs of one part: neighbouring windows paired at one distance."""
    pairs = np.unique(_pairs(rows, "n", "pairs"), axis=0)
    step = pairs[:, 3] - pairs[:, 1]
    pairs = pairs[np.lexsort((pairs[:, 1], step, pairs[:, 2], pairs[:, 0]))]
    step = pairs[:, 3] - pairs[:, 1]
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = (
        (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 2] != pairs[:-1, 2])
        | (step[1:] != step[:-1]) | (pairs[1:, 1] != pairs[:-1, 1] + 1)
    )
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(pairs)))
    columns = [pairs[heads, 0], pairs[heads, 1], size, pairs[heads, 2], pairs[heads, 3]]
    return pa.table([pa.array(c) for c in columns], ["doc", "start", "windows", "first_doc", "first_start"])


def merged(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Maximal intervals of ranges sorted by start; ranges that touch are joined."""
    if not len(starts):
        return []
    reach = np.maximum.accumulate(ends)
    heads = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return [{"start": int(starts[a]), "end": int(b)} for a, b in zip(heads, reach[np.append(heads[1:], len(starts)) - 1], strict=True)]


def cutter(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The task that cuts runs out of some documents and digests the words of runs.

    Asked: (doc, start, words, first_doc, first_start, cut); a run is cut out of the document where
    ``cut`` is true. Its digest is named by the place that the run is paired with.
    """
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    long = pa.int64()
    schema = pa.schema([("row", long), ("n_words", long), ("intervals", span), ("kept", pa.string()),
                        ("first_doc", long), ("first_start", long), ("words", long), ("digest", pa.binary())])

    def cut(texts: pa.Table, asked: pa.Table) -> pa.Table:
        d, s, m, fd, fs = (asked[c].to_numpy() for c in ("doc", "start", "words", "first_doc", "first_start"))
        own = np.asarray(asked["cut"].to_pylist(), dtype=bool)
        order = np.lexsort((s, d))
        d, s, m, fd, fs, own = (c[order] for c in (d, s, m, fd, fs, own))
        out = []
        for doc_id, text in zip(texts["doc"].to_pylist(), texts["text"], strict=True):
            words = (text.as_py() or b"").split()
            low, high = np.searchsorted(d, [doc_id, doc_id + 1])
            # of rows that share an id one may be shorter
            near = low + np.flatnonzero(s[low:high] + m[low:high] <= len(words))
            for k in near.tolist():
                digest = hashlib.blake2b(b" ".join(words[s[k] : s[k] + m[k]]), digest_size=16).digest()
                out.append((None, None, None, None, int(fd[k]), int(fs[k]), int(m[k]), digest))
            gone = near[own[near]]
            spans = merged(s[gone], s[gone] + m[gone])
            if spans:
                keep = np.ones(len(words), dtype=bool)
                for one in spans:
                    keep[one["start"] : one["end"]] = False
                kept = b" ".join(compress(words, keep.tolist()))
            else:
                kept = b" ".join(words)
            out.append((doc_id, len(words), spans, kept.decode(), None, None, None, None))
        columns = list(zip(*out, strict=True)) or [()] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return cut


def _cut(texts: DataFrame, asked: DataFrame, parts: int, window: int) -> DataFrame:
    part = F.pmod(F.xxhash64("doc"), F.lit(parts)).alias("part")
    left = texts.select(part, "doc", "text").groupBy("part")
    return left.cogroup(asked.select("*", part).groupBy("part")).applyInArrow(cutter(window), CUT)


def _windows_of_runs(runs: DataFrame) -> DataFrame:
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)).alias("step")
    return runs.select("doc", "start", "first_doc", "first_start", step).select(
        "doc", (F.col("start") + F.col("step")).alias("start"),
        "first_doc", (F.col("first_start") + F.col("step")).alias("first_start"),
    )


def told_apart(pairs: DataFrame, bad: DataFrame, texts: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """What becomes of windows whose hashes were equal though their words were not.

    Returns the places of all windows of such groups, and those of them that are repeats. ``pairs``
    are all pairs, ``bad`` those that failed. A window is paired with the first of its task's
    windows, that one perhaps with the first of all, so a group is found in a few steps.
    """
    places = bad.select("doc", "start").union(bad.select("first_doc", "first_start")).distinct()
    places = materialize(places, "places")
    size = places.count()
    while True:
        first = places.select(F.col("doc").alias("first_doc"), F.col("start").alias("first_start"))
        touched = pairs.join(places, ["doc", "start"], "left_semi").union(
            pairs.join(first, ["first_doc", "first_start"], "left_semi").select(*pairs.columns)
        )
        more = touched.select("doc", "start").union(touched.select("first_doc", "first_start"))
        places = materialize(places.union(more).distinct(), "places")
        if (grown := places.count()) == size:
            break
        size = grown
    words = F.split(F.decode("text", "utf-8"), r"[\x20\x09-\x0D]+")
    own = texts.join(places.select("doc").distinct(), "doc", "left_semi")
    split = own.select("doc", F.array_remove(words, "").alias("words")).join(places, "doc")
    text = F.array_join(F.slice("words", F.col("start").cast("int") + 1, F.lit(window)), " ")
    named = materialize(split.select("doc", "start", F.sha2(text, 256).alias("digest")), "window-words")
    first = named.groupBy("digest").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = named.join(first, "digest").filter(F.struct("doc", "start") > F.col("first"))
    return places, later.select("doc", "start").distinct()


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Rows (key, n_words, intervals, kept): the words left, and where words were removed.

    A word goes if it lies in a window whose words also start earlier: in a document of smaller
    key, or earlier in the same one. Windows are judged on the input. ``intervals`` are maximal,
    in words from 0, ends exclusive; ``kept`` joins the other words by blanks. Words are separated
    by ASCII blanks; a null text has none, a text shorter than the window loses none. Keys are
    whole numbers and should be unique: rows that share key and text count as one document and are
    each returned; of rows that share a key alone, each is cut where any of them repeats something.
    Rows with a null key are returned whole and are nobody's earlier copy. Other columns are not
    carried. The number of groups follows from the bytes of text, which one scan adds up.
    """
    if window < 1:
        raise ValueError("window from 1")
    slim = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc"),
        F.encode(F.col(f"`{text}`").cast("string"), "utf-8").alias("text"),
    )
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = math.ceil(math.log2(max(size / GROUP_BYTES, LEAST_GROUPS)))
    parts = max(1, math.ceil(size / PART_BYTES))
    known = slim.filter(F.col("doc").isNotNull())
    coarse = min(bits, FAN.bit_length() - 1)
    packed = known.filter(F.col("text").isNotNull()).mapInArrow(packer(window, coarse), PACKED)
    if bits > coarse:
        # as many tasks share a coarse group as it takes for each to fill its rows
        share = F.pmod("dealer", F.lit(max(1, math.ceil(size / CHUNK_BYTES / 2**coarse)))).alias("share")
        packed = packed.groupBy("bucket", share).applyInArrow(redealer(coarse, bits), PACKED)
    deal = min(parts, FAN)
    pairs = packed.groupBy("bucket").applyInArrow(matcher(parts, deal), PAIRS)
    if parts > deal:
        share = F.pmod("dealer", F.lit(math.ceil(2**bits / FAN))).alias("share")
        pairs = pairs.groupBy("part", share).applyInArrow(part_dealer(parts), PAIRS)
    runs = materialize(pairs.groupBy("part").applyInArrow(run_former, RUNS), "runs")
    runs = runs.withColumn("words", F.col("windows") + (window - 1))
    # what very many documents share is asked of the first of them once
    firsts = runs.select("first_doc", "first_start", "words").distinct()
    asked = runs.select("doc", "start", "words", "first_doc", "first_start", F.lit(True).alias("cut")).union(
        firsts.select("first_doc", "first_start", "words", "first_doc", "first_start", F.lit(False))
    )
    cut = materialize(_cut(known, asked, parts, window), "cut")
    place = ["first_doc", "first_start", "words"]
    told = cut.filter("digest is not null").groupBy(*place).agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    unequal = materialize(told.filter("a != b").select(*place), "unequal-runs")
    rows = cut.filter("digest is null").select("row", "n_words", "intervals", "kept")
    if not unequal.isEmpty():
        pairs = _windows_of_runs(runs)
        bad = _windows_of_runs(runs.join(unequal, place, "left_semi"))
        places, later = told_apart(pairs, bad, known, window)
        again = materialize(places.select("doc").distinct(), "cut-again")
        left = pairs.join(again, "doc", "left_semi").select("doc", "start").join(places, ["doc", "start"], "left_anti")
        asked = left.union(later).distinct().select(
            "doc", "start", F.lit(window).cast("long").alias("words"),
            F.col("doc").alias("first_doc"), F.col("start").alias("first_start"), F.lit(True).alias("cut"),
        )
        mended = _cut(known.join(again, "doc", "left_semi"), asked, parts, window).filter("digest is null")
        others = rows.join(again.withColumnRenamed("doc", "row"), "row", "left_anti")
        rows = others.unionByName(mended.select("row", "n_words", "intervals", "kept"))
    # rows without a key have no place in the order, so they are not compared
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    apart = slim.filter(F.col("doc").isNull()).select(F.col("doc").alias("row"), F.coalesce(F.decode("text", "utf-8"), F.lit("")).alias("text"))
    split = apart.select("row", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"))
    whole = split.select("row", F.size("words").cast("long").alias("n_words"), nothing.alias("intervals"), F.array_join("words", " ").alias("kept"))
    return rows.unionByName(whole).withColumnRenamed("row", key)
