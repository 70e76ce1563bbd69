"""Words, batches and stored intermediate results shared by the text operators.

Identifiers are integers. Texts are whole values of one row; a null text counts as empty unless an
operator says otherwise. Operators read only the columns they name, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from accordant.session import scratch_path

#: Separators of words: space and the control characters 09 to 0D. ``bytes.split()`` uses the same set.
_SPLIT = "[\\x20\\x09-\\x0D]+"

#: Bytes of a text to bytes of lower-cased ASCII letters, digits and non-ASCII characters, else a space.
PLAIN = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: Lower-cases A-Z only.
LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def word_array(text: Column) -> Column:
    """Words between the separators, in order; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPLIT), lambda w: w != "")


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str, rows: int = 256) -> DataFrame:
    """Apply ``make()(*columns)`` to slices of at most ``rows`` rows of each partition.

    ``make`` runs once per task, so what it builds (caches) lives as long as the task. Its result takes
    the columns of a slice as lists and gives the output columns as lists or arrays, in schema order; an
    attribute ``last`` of it, if any, is called at the end of the task for closing columns.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def batch(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                yield batch(step(*(part.column(i).to_pylist() for i in range(part.num_columns))))
        if hasattr(step, "last"):
            yield batch(step.last())

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` words at a time."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: A number for each byte, 0 for separators; powers of an odd number; and words up to which these hash a word.
_OF_BYTE = np.array([0 if b in b" \t\n\v\f\r" else xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_LONG = 512
_POWERS = np.multiply.accumulate(np.full(_LONG, 0x9E3779B97F4A7C15, np.uint64))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a slice of texts, in order, and the number of words of each text.

    Words are hashed together from their bytes; those of over 512 bytes one by one.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    of_byte = _OF_BYTE[data]
    inside = of_byte != 0
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    stops = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    place = np.arange(len(data)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    h = np.add.reduceat(of_byte * _POWERS[np.minimum(place, _LONG - 1)], starts)
    for i in np.flatnonzero(stops - starts > _LONG):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i]].tobytes())
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    return h, np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (order matters); empty if there are fewer words."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= h[i : len(h) - n + 1 + i]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out
