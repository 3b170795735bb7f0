"""Gapless numbers within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows that one window partition of the numbering sorts, about.
BUCKET_ROWS = 8_192


def same(keys: Sequence[str]) -> list:
    """Join condition between `l` and `r` on keys that may be NULL."""
    return [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]


def numbered(
    df: DataFrame, group: Sequence[str], identity: Sequence[str], name: str, first: Sequence[str] = ()
) -> DataFrame:
    """`df` (narrow, already written) with a number from 0 within `group`, without gaps.

    Rows are numbered by `first`, then by hash buckets of `identity`, then by `identity`. A cell (rows
    equal in `group` and `first`) gets as many buckets as its size asks for, and a window over the
    buckets gives where each starts. Equal rows are counted first and spread out again, so a row that
    repeats without end stays one row of the window. Only the named columns are returned.
    """
    keys = list(dict.fromkeys([*group, *first, *identity]))
    cell = [*group, *first]
    equal = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    cells = equal.groupBy(*cell).agg(F.expr("count(1) div {} + 1".format(BUCKET_ROWS)).alias("_buckets"))
    dealt = equal.alias("l").join(cells.alias("r"), same(cell)).select(
        *[F.col(f"l.{c}").alias(c) for c in keys],
        "_copies",
        F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in identity]), F.col("_buckets")).alias("_bucket"),
    )
    bucket = [*cell, "_bucket"]
    sums = dealt.groupBy(*bucket).agg(F.sum("_copies").alias("_held"))
    ordered = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in [*first, "_bucket"]])
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*bucket, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start"))
    within = (
        Window.partitionBy(*bucket).orderBy(*[F.col(c).asc_nulls_first() for c in identity])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.withColumn("_before", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
    joined = placed.alias("l").join(starts.alias("r"), same(bucket)).select(
        *[F.col(f"l.{c}").alias(c) for c in keys],
        (F.col("_before") + F.col("_start")).alias("_from"),
        "_copies",
    )
    return spread(joined, keys, name)


def spread(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Each row once per copy, numbered on from `_from`; arrays stay short whatever the copies."""
    blocks = F.explode(F.expr("sequence(0, (_copies - 1) div 1000000)"))
    one = F.explode(F.expr("sequence(_block * 1000000, least(_copies, (_block + 1) * 1000000) - 1)"))
    return (
        df.select(*keys, "_from", "_copies", blocks.alias("_block"))
        .select(*keys, "_from", one.alias("_i"))
        .select(*keys, (F.col("_from") + F.col("_i")).alias(name))
    )
