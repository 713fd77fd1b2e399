"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 entries, drawn from its code point. A three-letter
gram is the product of its letters' vectors, the first rotated by two places and the second by one,
so that order counts. A document is the sum of its grams' vectors, a language the sum of its
documents'. The predicted language is the one whose vector has the largest cosine with the
document's.

Text is lower-cased; every run of other characters than letters is one blank, and a blank stands
before and after the text. All sums are of whole numbers below 2**53, so they are exact and do not
depend on how rows are batched.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.text_units import spare_name

DIMENSIONS = 1024
SEED = 20_011
#: Default of the most languages that are learned: what the driver and each task may hold.
MOST_LANGUAGES = 10_000
#: Prediction for a text that is null or has no letter, or where no language was learned.
UNKNOWN = "und"

#: Texts are worked on in chunks of so many characters and texts; a longer text is cut into parts
#: whose vectors are added, with a blank at each cut.
CHUNK_CHARS, CHUNK_TEXTS = 1_000_000, 400
#: Up to this many gram codes are counted in a table; beyond, by sorting.
TABLE_CODES = 1 << 22
BLANK = 32


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([seed, code])).integers(0, 2, dimensions, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Bound vectors of the rows (first, second, third letter) of a table of code points."""
    codes, places = np.unique(grams, return_inverse=True)
    places = places.reshape(grams.shape)
    letters = np.stack([letter_vector(int(c), dimensions, seed) for c in codes])
    bound = np.roll(letters, 2, axis=1)[places[:, 0]]
    bound *= np.roll(letters, 1, axis=1)[places[:, 1]]
    bound *= letters[places[:, 2]]
    return bound.astype(np.float32)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of some lower-cased texts: code points (g, 3), and for every occurrence its text and gram."""
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the blank
    keep[0] = True
    kept = np.flatnonzero(keep)
    symbols = np.where(letter[kept], codes[kept], BLANK).astype(np.int64)
    owner = np.searchsorted(np.cumsum(sizes), kept - 1, side="right")
    inside = owner[1:-1] == owner[2:]  # the gram's last two symbols are of one text
    alphabet = np.flatnonzero(np.bincount(symbols))
    rank = np.zeros(alphabet[-1] + 1, dtype=np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    ranks, k = rank[symbols], len(alphabet)
    grams = (ranks[:-2] * k + ranks[1:-1]) * k + ranks[2:]
    grams, owners = grams[inside], owner[1:-1][inside]
    if k**3 <= TABLE_CODES:
        seen = np.flatnonzero(np.bincount(grams, minlength=1))
        index = np.zeros(k**3, dtype=np.int64)
        index[seen] = np.arange(len(seen))
        grams = index[grams]
    else:
        seen, grams = np.unique(grams, return_inverse=True)
    letters = alphabet[np.stack([seen // (k * k), seen // k % k, seen % k], axis=1)]
    return letters, owners, grams


def bundle(texts: list[str], group: np.ndarray, groups: int, dimensions: int, seed: int) -> np.ndarray:
    """The summed gram vectors of each group of texts, (groups, dimensions)."""
    letters, owners, grams = gram_counts(texts)
    total = np.zeros((groups, dimensions), dtype=np.float64)
    if not len(grams):
        return total
    owners = group[owners]
    for low in range(0, len(letters), 16_384):  # bounds the table of gram vectors
        high = min(low + 16_384, len(letters))
        part = (grams >= low) & (grams < high) if len(letters) > 16_384 else slice(None)
        counts = np.bincount(owners[part] * (high - low) + grams[part] - low, minlength=groups * (high - low))
        counts = counts.reshape(groups, high - low).astype(np.float32)
        total += counts @ gram_vectors(letters[low:high], dimensions, seed)
    return total


def chunks(column: pa.Array) -> Iterator[tuple[list[str], list[int]]]:
    """Parts of the lower-cased texts of a column, with the row of each part."""
    parts: list[str] = []
    rows: list[int] = []
    size = 0
    for row, text in enumerate(pc.utf8_lower(pc.fill_null(column, "")).to_pylist()):
        for low in range(0, max(len(text), 1), CHUNK_CHARS):
            part = text[low : low + CHUNK_CHARS]
            if parts and (size + len(part) > CHUNK_CHARS or len(parts) == CHUNK_TEXTS):
                yield parts, rows
                parts, rows, size = [], [], 0
            parts.append(part)
            rows.append(row)
            size += len(part)
    if parts:
        yield parts, rows


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED,
    most: int = MOST_LANGUAGES,
) -> dict[str, np.ndarray]:
    """Language vectors from the rows with a non-null language.

    Tasks add up their own texts first; what is shuffled is one vector per task and language, and
    what comes to the driver one vector per language (8 KB each). A column with more than ``most``
    values is no list of languages and raises ValueError. Texts without letters add nothing.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for parts, rows in chunks(batch.column(0)):
                names = sorted({langs[r] for r in rows})
                group = np.array([names.index(langs[r]) for r in rows])
                for name, vector in zip(names, bundle(parts, group, len(names), dimensions, seed), strict=True):
                    sums[name] = sums[name] + vector if name in sums else vector
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], ["lang", "v"])

    known = docs.filter(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")
    )
    sums = known.mapInArrow(add, "lang string, v array<double>").select("lang", F.posexplode("v"))
    rows = sums.groupBy("lang", "pos").agg(F.sum("col").alias("x")).limit(most * dimensions + 1).collect()
    if len(rows) > most * dimensions:
        raise ValueError(f"more than {most} languages")
    vectors: dict[str, np.ndarray] = {}
    for row in rows:
        vectors.setdefault(row["lang"], np.zeros(dimensions))[row["pos"]] = row["x"]
    return {name: v for name, v in sorted(vectors.items()) if v.any()}


def identify(
    docs: DataFrame, languages: Mapping[str, np.ndarray], text: str = "text", seed: int = SEED
) -> DataFrame:
    """Add lang_pred (string) and score (double, the cosine, 0 if negative) to every row.

    Columns of these names are replaced, others kept. Equal cosines give the language that sorts
    first; a null text or one without letters gives ``und`` and 0.
    """
    names = sorted(languages)
    table = np.stack([languages[n] / np.linalg.norm(languages[n]) for n in names]) if names else np.zeros((0, 1))
    slim, own = docs.drop("lang_pred", "score"), spare_name(docs, "text")
    schema = slim.schema.add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, last = batch.num_rows, batch.num_columns - 1
            best, score = [UNKNOWN] * n, np.zeros(n)
            carried = np.zeros((0, 0))
            open_row = -1
            for parts, rows in chunks(batch.column(last)) if names else ():
                first = rows[0]
                group = np.array(rows) - first
                sums = bundle(parts, group, int(group[-1]) + 1, table.shape[1], seed)
                if open_row == first:  # goes on with a text cut at the end of the last chunk
                    sums[0] += carried
                carried, open_row = sums[-1].copy(), first + len(sums) - 1
                norms = np.linalg.norm(sums, axis=1)
                cosines = (sums @ table.T) / np.where(norms > 0, norms, 1.0)[:, None]
                top = cosines.argmax(axis=1)
                for k in range(len(sums)):
                    if norms[k] > 0:
                        best[first + k] = names[top[k]]
                        score[first + k] = min(max(cosines[k, top[k]], 0.0), 1.0)
            columns = [batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[:last], "lang_pred", "score"],
            )

    return slim.withColumn(own, F.col(f"`{text}`").cast("string")).mapInArrow(predict, schema)


def is_held_out(key: str = "doc_id") -> Column:
    """The quarter of the rows that is never learned from."""
    return F.crc32(F.col(f"`{key}`").cast("string")) % 4 == 2
