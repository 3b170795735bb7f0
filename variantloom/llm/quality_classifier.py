"""Quality scores by regularised quadratic discriminant analysis over document statistics.

Each class is a Gaussian over transformed statistics of the text. Its covariance is shrunk towards
the pooled covariance and that towards a diagonal; the score is the posterior from the difference of
the two Mahalanobis log densities, computed with Cholesky factors made once per model.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm import text as T
from variantloom.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATISTICS = [
    "log_words", "word_length", "symbols", "exclamations", "bars", "capital_letters", "digits",
    "sentence_ends", "repeats_next", "distinct_words", "line_words", "distinct_lines", "capital_words", "commas",
]
MINIMUM_LABELS = 2  # of each class, else the model knows only the prior


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text, each transformed to be near a bell shape. Empty texts give zeros."""
    w = T.words(column)
    n = len(w.rows) - 1
    counts = w.counts().astype(float)
    safe = counts + 5.0  # keeps the ratios of very short texts from the edges

    def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
        member = np.zeros(256, dtype=bool)
        for a, b in ranges:
            member[a : b + 1] = True
        total = np.concatenate([[0], np.cumsum(member[w.data])])
        return (total[w.rows[1:]] - total[w.rows[:-1]]).astype(float)

    def chars(symbols: str) -> np.ndarray:
        return bytes_in(*[(ord(c), ord(c)) for c in symbols])

    letters = np.maximum(np.diff(w.rows), 1)
    held = np.add.reduceat(np.append(w.ends - w.starts, 0), np.minimum(w.first[:-1], len(w.starts))) * (counts > 0) if n else np.zeros(0)
    row = w.row_of()
    again = np.zeros(len(row), dtype=bool)
    if len(row) > 1:
        again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (row[1:] == row[:-1])
    different = distinct_per_row(row, w.hashes, n)
    first_byte = w.data[w.starts] if len(w.starts) else np.zeros(0, dtype=np.uint8)
    capital = np.bincount(row[(first_byte >= 65) & (first_byte <= 90)], minlength=n)
    lines, different_lines = line_counts(w, n)
    out = np.column_stack([
        np.log1p(counts),
        np.log1p(held / safe),
        np.log1p(100 * chars("#*$%&<>") / safe),
        np.log1p(100 * chars("!") / safe),
        np.log1p(100 * chars("|") / safe),
        np.sqrt(bytes_in((65, 90)) / letters),
        np.log1p(100 * bytes_in((48, 57)) / letters),
        np.sqrt(chars(".?") / safe),
        np.log1p(100 * np.bincount(row[again], minlength=n) / safe),
        np.log1p(different) - np.log1p(counts),
        np.log1p(counts / np.maximum(lines, 1)),
        np.log1p(different_lines) - np.log1p(lines),
        np.sqrt(capital / safe),
        np.sqrt(chars(",;:") / safe),
    ])
    return np.where(counts[:, None] > 0, out, 0.0)


def distinct_per_row(row: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Different hashes of each of n rows."""
    if not len(row):
        return np.zeros(n)
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.bincount(r[new], minlength=n).astype(float)


def line_counts(w: T.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and how many of them differ."""
    if not len(w.starts):
        return np.zeros(n), np.zeros(n)
    row = w.row_of()
    breaks = np.concatenate([[0], np.cumsum(w.data == 10)])
    line = breaks[w.starts]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    at = np.flatnonzero(new)
    # A line's hash from its words in order.
    place = np.arange(len(row)) - np.repeat(at, np.diff(np.append(at, len(row))))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(T.mix(w.hashes + place.astype(np.uint64) * np.uint64(T.STEP)), at)
    return np.bincount(row[at], minlength=n).astype(float), distinct_per_row(row[at], sums, n)


def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and the statistics of its text."""
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            x = statistics(piece.column("text"))
            arrays = [piece.column("doc_id"), *[pa.array(x[:, j]) for j in range(x.shape[1])]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *STATISTICS])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS for every row, written once."""
    T.small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{c} double" for c in STATISTICS)
    return written(docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, {columns}"), "statistics")


@dataclass(frozen=True)
class Model:
    """Prior log odds, and for each class (0, 1) its mean, inverted Cholesky factor and log determinant.

    Without enough labels of both classes there are no factors, and every score is the prior.
    """

    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        odds = np.full(len(x), self.prior)
        if self.means is not None:
            for k, sign in ((0, -1.0), (1, 1.0)):
                z = (x - self.means[k]) @ self.factors[k].T
                odds += sign * (-0.5 * (z * z).sum(axis=1) - self.constants[k])
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fitted(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = 0.1, diagonal: float = 0.05) -> Model:
    """The model from each class's weight, sums and sums of products.

    `pooled` is the share of the common covariance in each class's, `diagonal` that of its diagonal.
    """
    weight = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
    prior = float(np.log((weight[1] + 1) / (weight[0] + 1)))
    if min(weight.values()) < MINIMUM_LABELS:
        return Model(prior)
    means = {k: moments[k][1] / weight[k] for k in (0, 1)}
    scatter = {k: moments[k][2] - weight[k] * np.outer(means[k], means[k]) for k in (0, 1)}
    common = (scatter[0] + scatter[1]) / sum(weight.values())
    factors, constants = [], []
    for k in (0, 1):
        cov = (1 - pooled) * scatter[k] / weight[k] + pooled * common
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(common)) + 1e-6 * np.eye(len(cov))
        cholesky = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(cholesky))
        constants.append(np.log(np.diag(cholesky)).sum())
    return Model(prior, np.array([means[0], means[1]]), np.array(factors), np.array(constants))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4. False for NULL."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit the model on all labelled rows that are not held out: sums over the cluster, one small solve here.

    Labels other than 0 and 1 and rows without an id are left out; a label that repeats counts as
    often, also if it contradicts another of the same id.
    """
    given = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id", F.col(label).cast("int").alias("_label"))
        .agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    )
    rows = measured.filter(~held_out(F.col("doc_id"))).join(given, "doc_id")
    n = len(STATISTICS)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    weight = F.col("_weight")
    sums = [F.sum(weight * F.col(c)).alias(f"s{i}") for i, c in enumerate(STATISTICS)]
    products = [F.sum(weight * F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]
    moments = {}
    for row in rows.groupBy("_label").agg(F.sum(weight).alias("w"), *sums, *products).collect():
        square = np.zeros((n, n))
        for i, j in pairs:
            square[i, j] = square[j, i] = row[f"p{i}_{j}"]
        moments[row["_label"]] = (row["w"], np.array([row[f"s{i}"] for i in range(n)]), square)
    return fitted(moments)


def scored(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for every row of statistics."""
    kind = measured.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    return measured.select("doc_id", *STATISTICS).mapInArrow(score, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row, also for NULL, empty and repeated texts.

    The text alone decides the score: equal texts score the same. A NULL text counts as empty. Other
    columns of `docs` are not read. An empty table gives an empty table; without labels of both kinds
    every score is the prior.
    """
    measured = document_statistics(docs)
    rows = scored(measured, train(measured, labels))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
