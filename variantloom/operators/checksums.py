"""Differences of two tables by checksums of buckets: only rows of buckets that differ are compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions.labels import col
from variantloom.operators.stats import dataset_diff
from variantloom.session import small_side, written

# Buckets of the first round, and how many parts a bucket that differs is cut into for the second.
FIRST_BITS = 12
SECOND_BITS = 12
HALF = 0xFFFFFFFF


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row; NULL is a value of its own."""
    cells = [part for c in columns for part in (col(c), col(c).isNull())]
    return F.xxhash64(F.lit(seed), *cells)


def marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns with _h, which deals rows to buckets, and _g, a second hash for the sums."""
    return df.select(*[col(c) for c in columns], row_hash(columns, 0).alias("_h"), row_hash(columns, 1).alias("_g"))


def bucket(bits: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - bits)


def sums(rows: DataFrame, bits: int) -> DataFrame:
    """_bucket, n and order-free sums of both hashes, in halves so that they cannot overflow."""
    halves = [
        F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(HALF))).alias(f"{h}{shift}") for h in ("_h", "_g") for shift in (0, 32)
    ]
    return rows.groupBy(bucket(bits).alias("_bucket")).agg(F.count(F.lit(1)).alias("n"), *halves)


def unequal(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """Buckets whose count or sums differ between two marked tables: at most a row per bucket and task is shuffled."""
    both = sums(left, bits).withColumn("_side", F.lit(1)).unionByName(sums(right, bits).withColumn("_side", F.lit(-1)))
    names = [c for c in both.columns if c not in ("_bucket", "_side")]
    differs = [F.sum(F.col(c) * F.col("_side")).alias(c) for c in names]
    return both.groupBy("_bucket").agg(*differs).filter(" OR ".join(f"{c} <> 0" for c in names)).select("_bucket")


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows over the common columns that the two tables do not hold equally often.

    n_left, n_right and `_merge` are those of `dataset_diff`. Buckets of rows are compared by checksums; those that differ are
    cut up once more, and only rows of parts that differ then are shuffled. Equal tables exchange checksums only.
    """
    common = [c for c in left.columns if c in right.columns]
    a, b = marked(left, common), marked(right, common)
    rough = written(unequal(a, b, FIRST_BITS), "buckets")
    cut = [side.join(small_side(rough), bucket(FIRST_BITS) == F.col("_bucket"), "left_semi") for side in (a, b)]
    fine = written(unequal(*cut, FIRST_BITS + SECOND_BITS), "buckets")
    rest = [side.join(small_side(fine), bucket(FIRST_BITS + SECOND_BITS) == F.col("_bucket"), "left_semi").drop("_h", "_g") for side in (a, b)]
    return dataset_diff(*rest).filter("n_left <> n_right")
