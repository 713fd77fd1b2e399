"""Rabin-Karp hashes of all windows of words, over whole columns of texts at once.

A polynomial over the bytes of each word gives the word's value; a polynomial over the values of a
window's words gives the window's hash. Both are taken modulo two primes below 2**31, which make a
hash of 62 bits, and prefix sums do the rolling: the hash of a range is the difference of two
prefixes times an inverse power. A prime modulus has no words that collide whatever the base is;
whoever needs certainty compares the words all the same.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: The primes, and for each a base for bytes and one for words.
PRIMES = (2**31 - 1, 2**31 - 19)
BYTE_BASES, WORD_BASES = (0x2545F491, 0x1B873593), (0x3C6EF372, 0x27D4EB2F)
#: Bytes hashed at once; a piece ends between words.
PIECE = 1 << 19


@lru_cache(maxsize=16)
def powers(base: int, prime: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 modulo the prime; ``n`` is rounded up to a power of two by the callers."""
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


def room_for(n: int) -> int:
    return max(PIECE, 1 << max(n, 1).bit_length())


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, prime: int, bits: int = 31) -> np.ndarray:
    """The polynomial of each range of values (of so many bits), its first value having power 0."""
    n = len(values)
    p = np.uint64(prime)
    terms = values * powers(base, prime, room_for(n))[:n]
    if bits + 31 + n.bit_length() > 64:  # else the sums fit as they are
        terms %= p
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=prefix[1:])
    return (prefix[ends] - prefix[starts]) % p * powers(pow(base, -1, prime), prime, room_for(n))[starts] % p


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in UTF-8 bytes; blank and tab to return separate words."""
    solid = np.empty(len(data) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_and(data != 32, (data < 9) | (data > 13), out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two numbers per word, one modulo each prime, equal for equal words."""
    out = np.empty((len(PRIMES), len(starts)), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, low + PIECE, side="right")))
        part = data[low : int(ends[stop - 1])].astype(np.uint64) + np.uint64(1)
        s, e = starts[at:stop] - low, ends[at:stop] - low
        for k, (base, prime) in enumerate(zip(BYTE_BASES, PRIMES, strict=True)):
            out[k, at:stop] = ranges(part, s, e, base, prime, bits=9)
        at = stop
    return out


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` neighbouring words; documents are not told apart here."""
    n = values.shape[1] - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(n)
    high, low = (
        ranges(own, starts, starts + width, base, prime)
        for own, base, prime in zip(values, WORD_BASES, PRIMES, strict=True)
    )
    return mixed(high << np.uint64(31) | low)
