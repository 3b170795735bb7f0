"""Words and word n-grams of Arrow text columns as 64-bit hashes, computed with numpy.

A word is a run of bytes other than space and \\x09-\\x0D; in UTF-8 these bytes never occur
inside a character. Work goes block by block: memory is bounded by BLOCK or the longest word.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Tasks get these helpers with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 1 << 20
# Rows of an Arrow batch: few enough that a batch of long texts fits a Python worker.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "".join(chr(c) for c in range(65, 91))
    return F.translate(text, upper, upper.lower())


def word_array(text: Column) -> Column:
    """All words of a text as an array; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """An independent hash of a hash for each seed."""
    with np.errstate(over="ignore"):
        return mix(np.asarray(x, dtype=np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64)))


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE = mix(np.arange(1, 257, dtype=np.uint64))
LOWERED = BYTE.copy()
LOWERED[65:91] = BYTE[97:123]
STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BACK = pow(STEP, -1, 1 << 64)
POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    if base not in POWERS or len(POWERS[base]) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            POWERS[base] = np.multiply.accumulate(steps)
    return POWERS[base][:n]


@dataclass
class Words:
    """Words of consecutive texts; the words of text i are first[i] ... first[i + 1] - 1."""

    data: np.ndarray
    rows: np.ndarray  # byte offsets of the texts, one more than there are texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its texts; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(column: pa.Array, lower: bool = False, separators: np.ndarray = IS_SPACE) -> Words:
    """Words of each text of an Arrow column; `separators` says for each byte whether it ends words."""
    data, rows = buffers(column)
    n = len(data)
    space = separators[data]
    before = np.ones(n, dtype=bool)
    before[1:] = space[:-1]
    after = np.ones(n, dtype=bool)
    after[:-1] = space[1:]
    inner = rows[(rows > 0) & (rows < n)]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    first = np.searchsorted(starts, rows)
    return Words(data, rows, starts, ends, first, word_hashes(data, starts, ends, LOWERED if lower else BYTE))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: a polynomial over the block, shifted back to the word's start."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + BLOCK, side="right")))
        b = ends[j - 1]
        total = np.zeros(b - a + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(table[data[a:b]] * powers(STEP, b - a), out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            hashes[i:j] = mix((total[e] - total[s]) * powers(BACK, b - a)[s] + (e - s).astype(np.uint64))
        i = j
    return hashes


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each position on; n - 1 fewer than words."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    size = len(hashes) - n + 1
    out = hashes[:size].copy()
    with np.errstate(over="ignore"):
        for j in range(1, n):
            out = out * np.uint64(STEP) + hashes[j : j + size]
    return mix(out)


def row_ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of all texts: their hashes, the text of each, and the first word of each."""
    grams = ngrams(w.hashes, n)
    row = w.row_of()
    at = np.flatnonzero(row[: len(grams)] == row[n - 1 :]) if len(grams) else np.zeros(0, dtype=np.int64)
    return grams[at], row[at], at


def row_sums(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct hash of a row; `row` rises."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return row[first], hashes[first], np.diff(np.append(first, len(row)))


def pieces(batch: pa.RecordBatch, column: str, size: int = BLOCK * 4) -> list[pa.RecordBatch]:
    """A batch cut into runs of rows whose text has about `size` bytes, at least one row each."""
    lengths = np.diff(buffers(batch.column(column))[1])
    out, start, held = [], 0, 0
    for i, length in enumerate(lengths):
        if i > start and held + length > size:
            out.append(batch.slice(start, i - start))
            start, held = i, 0
        held += length
    if start < len(lengths):
        out.append(batch.slice(start))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's longs."""
    return np.ascontiguousarray(x).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)
