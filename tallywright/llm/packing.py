"""Best-fit packing of token sequences, by residual bins merged in a tree.

A document longer than a sequence is cut into full pieces and one shorter piece, which comes first.
Full pieces are sequences of their own. Each task packs the shorter pieces of its documents by
best fit, longest first. Bins that are nearly full are done; the underfull ones go up a tree as
items: a few tasks' bins meet in one group and are packed again by best fit, until one group is
left. Only bins travel, never tokens or pieces.

After a best fit no two bins of a group fit together, so at most one of them is half full or less,
and only such bins can still be placed into others. A group therefore hands up that bin and, of the
others, the emptiest ones, as many as bins can come in on the levels above: a bin that finds a
place anywhere finds one in these. So a group never holds more than fan-in squared times the
number of levels, whatever the input.
"""

from __future__ import annotations

import array
import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.session import materialize

SEQUENCE_TOKENS = 1024
END_ID = 2
#: A bin with at most this many free places is done.
NEARLY_FULL = 8
#: Groups that meet in one group of the next level.
FAN_IN = 16
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, offset bigint, fill int"
BINS = "bin bigint, fill int, members array<struct<bin:bigint,shift:int>>, node int, open boolean"


def best_fit(sizes: Sequence[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Pack by best fit, largest first (equal ones in the given order).

    Returns the bin and offset of each item, and the fill of each bin. A bit for each free size
    that some open bin has makes the tightest fit one shift and one lowest-bit search.
    """
    bins, offsets, fills = [0] * len(sizes), [0] * len(sizes), []
    free: dict[int, list[int]] = {}
    present = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        above = present >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                present &= ~(1 << room)
        else:
            at, room = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = at, fills[at]
        fills[at] += size
        if left := room - size:
            free.setdefault(left, []).append(at)
            present |= 1 << left
    return bins, offsets, fills


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to token ids, for a byte-level BPE in the tokenizers format.

    The file's own vocabulary is run by the faster of the two libraries that read such
    vocabularies; ``tests/llm`` holds their ids against each other. Ids of byte-level tokens rise
    in the order of their merges, which is checked here.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    ids = [spec["model"]["vocab"]["".join(pair)] for pair in merged]
    if ids != sorted(ids) or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level BPE in merge order")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(name in text for name in special):
            return own.encode(text, allowed_special="all")
        return own.encode_ordinary(text)

    return encode


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def pack_task(batches: Iterator[pa.RecordBatch], path: str, limit: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Tokenize, cut and pack the documents of one task."""
    encode = encoder(path)
    base = TaskContext.get().partitionId() << 32
    bins = 0
    rest: list[tuple] = []
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    schema = pa.schema(list(zip(columns, kinds, strict=True)))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema)

    for part in batches:
        rows = []
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            ids = array.array("I", encode(text.as_py() or ""))
            ids.append(end_id)
            first = len(ids) % limit if len(ids) > limit else len(ids)
            cuts = [0, *range(first, len(ids), limit)] if 0 < first < len(ids) else [*range(0, len(ids), limit)]
            for piece, start in enumerate(cuts):
                stop = cuts[piece + 1] if piece + 1 < len(cuts) else len(ids)
                crc, length = zlib.crc32(_little(ids[start:stop])), stop - start
                if length == limit:
                    rows.append((doc_id, piece, start, length, crc, base + bins, 0, limit))
                    bins += 1
                else:
                    rest.append((doc_id, piece, start, length, crc))
        if rows:
            yield batch(rows)
    if rest:
        placed, offsets, fills = best_fit([r[3] for r in rest], limit)
        rows = [
            (*r, base + bins + at, offset, 0 if offset else fills[at])
            for r, at, offset in zip(rest, placed, offsets, strict=True)
        ]
        for k in range(0, len(rows), 50_000):
            yield batch(rows[k : k + 50_000])


def _little(ids: array.array) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def merge_group(frame: pd.DataFrame, capacity: int, nearly: int, hosts: int) -> pd.DataFrame:
    """Pack the bins of one group again; keep open what can still matter further up."""
    frame = frame.sort_values(["fill", "bin"], ascending=[False, True], kind="stable")
    at, shifts, fills = best_fit([int(x) for x in frame["fill"]], capacity)
    members: list[list] = [[] for _ in fills]
    names = [0] * len(fills)
    for row, k, shift in zip(frame.itertuples(), at, shifts, strict=True):
        if not members[k]:
            names[k] = row.bin
        members[k] += [{"bin": m["bin"], "shift": m["shift"] + shift} for m in row.members]
    order = sorted(range(len(fills)), key=lambda k: (fills[k], names[k]))
    small = [k for k in order if 2 * fills[k] <= capacity]
    large = [k for k in order if 2 * fills[k] > capacity and fills[k] < capacity - nearly]
    still = {*small, *large[:hosts]}
    return pd.DataFrame(
        {
            "bin": names,
            "fill": fills,
            "members": members,
            "node": int(frame["node"].iloc[0]) if len(frame) else 0,
            "open": [k in still for k in range(len(fills))],
        }
    )


def merger(capacity: int, nearly: int, hosts: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda frame: merge_group(frame, capacity, nearly, hosts)


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    tokenizer: str = TOKENIZER,
    limit: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    nearly: int = NEARLY_FULL,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed once each; rows with a null
    key keep it. Other columns are not carried. An empty table gives no rows.
    """
    if limit < 1 or not 0 <= nearly < limit or fan_in < 2:
        raise ValueError("limit from 1, nearly from 0 to below limit, fan_in from 2")
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string"))
    pieces = materialize(
        slim.mapInArrow(lambda batches: pack_task(batches, tokenizer, limit, end_id), PIECES), "pieces"
    )
    node = F.shiftright("bin", 32).cast("int")
    bins = pieces.filter((F.col("fill") > 0) & (F.col("fill") < limit - nearly)).select(
        "bin", "fill", F.array(F.struct("bin", F.lit(0).alias("shift"))).alias("members"),
        node.alias("node"), F.lit(True).alias("open"),
    )
    tasks = bins.agg(F.max("node")).first()[0]
    levels = 1
    while tasks is not None and fan_in**levels <= tasks:
        levels += 1
    done = []
    for level in range(levels):
        hosts = fan_in * (levels - level)
        # on the first level a task's own bins are one group each: what cannot matter stays behind
        for step in (1, fan_in) if level == 0 else (fan_in,):
            grouped = bins.filter("open").withColumn("node", F.expr(f"node div {step}")).groupBy("node")
            bins = materialize(
                grouped.applyInPandas(merger(limit, nearly, hosts), BINS), "bins"
            )
            done.append(bins.filter("not open"))
    done.append(bins.filter("open"))
    moved = None
    for part in done:
        part = part.filter(F.size("members") > 1).select(
            F.col("bin").alias("root"), F.inline("members").alias("moved_bin", "shift")
        )
        moved = part if moved is None else moved.unionByName(part)
    moved = materialize(moved, "moves")
    return pieces.join(moved, F.col("bin") == F.col("moved_bin"), "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
