"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Test items go to all tasks in blocks of bounded size. All n-grams of an item are its seeds, however
many documents hold them. One pass finds them in every text, and where enough different places of an
item lie close together, aligns that part of the text with the item unless too few of the item's
words occur there to reach the score. Documents are never shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from variantloom.llm import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 16 * 1024 * 1024  # item text that tasks hold at once, about
MATCH, MISMATCH, GAP = 2, -1, -1
SIEVE = 1 << 22
ENTRIES = 1 << 20  # places of seeds looked at together, or those of one text


@dataclass(frozen=True)
class Limits:
    n: int = 3  # words in a seed
    score: float = 0.4  # share of the alignment score of an identical copy


@dataclass
class Seeds:
    """Sorted seed hashes with the items and places they stand for, and the items' words."""

    ids: list
    words: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def sieve(self) -> np.ndarray:
        out = np.zeros(SIEVE, dtype=bool)
        out[(self.hashes % np.uint64(SIEVE)).astype(np.int64)] = True
        return out


def seeds_of(items: list[tuple], n: int) -> Seeds:
    """All n-grams of the items (id, text) as seeds. Items with fewer words have none."""
    w = T.words(pa.array([text or "" for _, text in items], pa.large_string()), lower=True)
    words = [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
    grams, item, at = T.row_ngrams(w, n)
    place = at - w.first[item]
    order = np.argsort(grams, kind="stable")
    return Seeds([i for i, _ in items], words, grams[order], item[order], place[order])


def found(grams: np.ndarray, hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Positions of those grams that are among the sorted hashes."""
    at = np.flatnonzero(sieve[(grams % np.uint64(SIEVE)).astype(np.int64)])
    spot = np.minimum(np.searchsorted(hashes, grams[at]), len(hashes) - 1)
    return at[hashes[spot] == grams[at]]


def align(part: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: best local score and the ends (exclusive) of the alignment in `part` and `item`."""
    m = len(part)
    slope = -GAP * np.arange(m + 1)
    above = np.zeros(m + 1, dtype=np.int64)
    best, end, item_end = 0, 0, 0
    for i, word in enumerate(item):
        row = np.zeros(m + 1, dtype=np.int64)
        step = np.where(part == word, MATCH, MISMATCH)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + step, above[1:] + GAP))
        # Gaps along the row: the best start so far, less its distance.
        row = np.maximum.accumulate(row + slope) - slope
        j = int(row.argmax())
        if row[j] > best:
            best, end, item_end = int(row[j]), j, i + 1
        above = row
    return best, end, item_end


def least_places(size: int | np.ndarray, n: int) -> int | np.ndarray:
    """Different places of an item of `size` words whose seeds must lie close together."""
    return np.maximum(1, (size - n + 1) // 10)


def aligned_spans(words: np.ndarray, hits: np.ndarray, places: np.ndarray, item: np.ndarray, limits: Limits) -> tuple[float, int, int] | None:
    """The best alignment of an item with a text: share of the full score, first and end word.

    `hits` are the seeds' positions in the text, ascending, `places` theirs in the item.
    """
    cuts = np.flatnonzero(np.diff(hits) > len(item)) + 1
    margin = len(item) // 4 + 4
    best = None
    for group in np.split(np.arange(len(hits)), cuts):
        if len(np.unique(places[group])) < least_places(len(item), limits.n):
            continue
        start = max(0, int((hits[group] - places[group]).min()) - margin)
        stop = min(len(words), int((hits[group] + len(item) - places[group]).max()) + margin)
        # A match needs a word of the item, so no score is higher than that of all its words found here.
        if np.isin(item, words[start:stop]).mean() < limits.score:
            continue
        score, end, item_end = align(words[start:stop], item)
        share = score / (MATCH * len(item))
        if share >= limits.score and (best is None or share > best[0]):
            _, back, _ = align(words[start : start + end][::-1], item[:item_end][::-1])
            best = (share, start + end - back, start + end)
    return best


def text_hits(column: pa.Array, seeds: Seeds, sieve: np.ndarray, limits: Limits) -> Iterator[tuple[int, int, float, int, int, int]]:
    """Row, item, share, first word, end word, words of the text, for every contaminated text."""
    w = T.words(column, lower=True)
    grams, row, at = T.row_ngrams(w, limits.n)
    hit = found(grams, seeds.hashes, sieve)
    first = np.searchsorted(seeds.hashes, grams[hit], side="left")
    counts = np.searchsorted(seeds.hashes, grams[hit], side="right") - first
    row, at = row[hit], at[hit]
    sizes = np.array([len(x) for x in seeds.words])
    for cut in runs_of_rows(row, counts):
        c = counts[cut]
        entry = np.repeat(first[cut], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        rows, spots = np.repeat(row[cut], c), np.repeat(at[cut], c)
        item, place = seeds.item[entry], seeds.place[entry]
        order = np.lexsort((spots, place, item, rows))
        rows, spots, item, place = rows[order], spots[order], item[order], place[order]
        new = np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(item) != 0)])
        places = np.add.reduceat(new | np.concatenate([[True], np.diff(place) != 0]), np.flatnonzero(new), dtype=np.int64)
        ends = np.append(np.flatnonzero(new), len(rows))
        enough = places >= least_places(sizes[item[ends[:-1]]], limits.n)
        for start, stop in zip(ends[:-1][enough], ends[1:][enough]):
            group = start + np.lexsort((place[start:stop], spots[start:stop]))
            r, i = int(rows[start]), int(item[start])
            a, b = w.first[r], w.first[r + 1]
            span = aligned_spans(w.hashes[a:b], spots[group] - a, place[group], seeds.words[i], limits)
            if span:
                yield r, i, *span, int(b - a)


def runs_of_rows(row: np.ndarray, counts: np.ndarray) -> Iterator[slice]:
    """Whole texts' hits, in runs that stand for about ENTRIES places."""
    total = np.concatenate([[0], np.cumsum(counts)])
    start = 0
    while start < len(row):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + ENTRIES, side="right")) - 1)
        stop = int(np.searchsorted(row, row[stop - 1], side="right"))
        yield slice(start, stop)
        start = stop


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items' (item_id, text) in blocks of about `block_bytes`, in a stable order."""
    rows = items.select("item_id", "text").filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    for i in range(blocks):
        own = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [tuple(r) for r in own.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word, n_words: texts that hold a test item, or an edited copy.

    A row for each input row and item whose best alignment reaches `score` of an identical copy's; the
    words first_word ... end_word - 1 are aligned. Words are compared with A-Z in lower case. NULL and
    empty texts hold nothing; items with fewer than `n` words or NULL text are never found; equal items
    are found each for itself, repeated rows too. Only doc_id, item_id and the texts are read.
    """
    T.small_batches(docs.sparkSession)
    doc_kind, item_kind = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, score double, first_word bigint, end_word bigint, n_words bigint"
    out = None
    for block in item_blocks(items):
        rows = docs.select("doc_id", "text").mapInArrow(hit_writer(seeds_of(block, limits.n), limits, to_arrow_type(item_kind)), schema)
        out = rows if out is None else out.union(rows)
    return out


def hit_writer(seeds: Seeds, limits: Limits, item_kind: pa.DataType) -> Callable:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = seeds.sieve()
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                hits = list(text_hits(piece.column("text"), seeds, sieve, limits)) if len(seeds.hashes) else []
                rows = [list(x) for x in zip(*hits)] if hits else [[] for _ in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(rows[0], pa.int64())),
                        pa.array([seeds.ids[i] for i in rows[1]], item_kind),
                        pa.array(rows[2], pa.float64()), *[pa.array(x, pa.int64()) for x in rows[3:]],
                    ],
                    names=["doc_id", "item_id", "score", "first_word", "end_word", "n_words"],
                )

    return write


def decontaminated(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`docs` without the rows whose text holds a test item; all columns stay, nothing is shuffled."""
    T.small_batches(docs.sparkSession)
    for block in item_blocks(items):
        docs = docs.mapInArrow(hit_filter(seeds_of(block, limits.n), limits), docs.schema)
    return docs


def hit_filter(seeds: Seeds, limits: Limits) -> Callable:
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = seeds.sieve()
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                clean = np.ones(piece.num_rows, dtype=bool)
                if len(seeds.hashes):
                    clean[[hit[0] for hit in text_hits(piece.column("text"), seeds, sieve, limits)]] = False
                yield piece.filter(pa.array(clean))

    return keep
