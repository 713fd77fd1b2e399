"""Terms of texts as packed numbers: counted by radix sort, without a Python object per term.

A term is a run of ASCII letters and of bytes beyond ASCII, with A-Z in lower case. Terms are dealt
into buckets by their length in bytes: up to 8 bytes make one uint64, up to 16 two, both sorted by
their 16-bit digits, the last one first. Longer ones go to a bucket for each power of two, where
they are sorted as bytes. Sorting is stable, so equal terms stay in the order of their documents,
and runs of equal terms are counted by group and by document at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of the terms that one and two numbers hold.
ONE, TWO = 8, 16


def _classes() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    upper = (codes >= 65) & (codes <= 90)
    inside = upper | ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    return inside, np.where(upper, codes + 32, codes).astype(np.uint8)


INSIDE, FOLDED = _classes()


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = INSIDE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def pack(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each term as a number, the first byte highest; missing bytes are 0.

    No term holds a byte 0, so equal numbers mean equal terms. ``padded`` has 8 bytes more than
    the texts.
    """
    taken = np.clip(lengths, 0, 8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.minimum(starts, len(padded) - 8)]
    whole = np.ascontiguousarray(rows).view(">u8").reshape(-1).astype(np.uint64)
    gone = (8 * (8 - taken)).astype(np.uint64)
    # a shift by 64 is undefined, so that case is cleared apart
    return np.where(taken > 0, (whole >> np.minimum(gone, np.uint64(63))) << np.minimum(gone, np.uint64(63)), np.uint64(0))


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by columns of uint64, the first one highest, sorted digit by digit."""
    order = np.arange(len(keys[0]))
    for column in reversed(keys):
        for shift in range(0, 64, 16):
            digit = (column >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(new: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and number of documents of each run; ``new`` marks where one starts."""
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(new))
    other = new.copy()
    other[1:] |= docs[1:] != docs[:-1]
    seen = np.concatenate([[0], np.cumsum(other)])
    return heads, ends - heads, seen[ends] - seen[heads]


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) of each group of texts, in one part per bucket."""
    order = np.argsort(groups, kind="stable")
    ends = np.cumsum([len(texts[i]) + 1 for i in order])
    joined = b"\n".join([*(texts[i] for i in order), b"\0" * ONE])
    padded = FOLDED[np.frombuffer(joined, dtype=np.uint8)]
    starts, stops = term_spans(padded)
    lengths = stops - starts
    docs = np.searchsorted(ends, starts, side="right")
    own = groups[order][docs] if len(docs) else np.zeros(0, dtype=groups.dtype)
    short = lengths <= ONE
    middle = ~short & (lengths <= TWO)
    for chosen, width in ((short, 1), (middle, 2)):
        rows = np.flatnonzero(chosen)
        if not len(rows):
            continue
        at, size = starts[rows], lengths[rows]
        keys = [pack(padded, at + 8 * k, size - 8 * k) for k in range(width)]
        # groups are in order already, and the sort is stable
        by_term = radix_order(keys)
        new = np.ones(len(rows), dtype=bool)
        sorted_keys = [key[by_term] for key in keys]
        group = own[rows][by_term]
        new[1:] = group[1:] != group[:-1]
        for key in sorted_keys:
            new[1:] |= key[1:] != key[:-1]
        heads, n, seen = runs(new, docs[rows][by_term])
        packed = np.stack([key[heads] for key in sorted_keys], axis=1).astype(">u8")
        terms = np.ascontiguousarray(packed).view(f"S{8 * width}").reshape(-1).tolist()
        yield group[heads], terms, n, seen
    long = np.flatnonzero(lengths > TWO)
    # a bucket for each power of two, so that none is padded to more than twice its bytes
    bucket = np.ceil(np.log2(lengths[long])).astype(np.int64) if len(long) else long
    for power in np.unique(bucket):
        rows = long[bucket == power]
        raw = padded.tobytes() if len(rows) > 64 else padded
        terms = [bytes(raw[a:b]) for a, b in zip(starts[rows], stops[rows], strict=True)]
        by_term = sorted(range(len(rows)), key=terms.__getitem__)
        group, seen_docs = own[rows][by_term], docs[rows][by_term]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        new[1:] |= np.fromiter(
            (terms[a] != terms[b] for a, b in zip(by_term, by_term[1:], strict=False)), dtype=bool, count=len(rows) - 1
        )
        heads, n, seen = runs(new, seen_docs)
        yield group[heads], [terms[by_term[h]] for h in heads.tolist()], n, seen
