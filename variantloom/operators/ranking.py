"""First or last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.functions.labels import col


def first_per_key(df: DataFrame, by: Sequence[str], *order: Column) -> DataFrame:
    """First row per key. Spark cuts each key to one row before the shuffle, so hot keys stay small.

    Key columns that are not text come first: the sort compares them fastest.
    """
    kinds = dict(df.dtypes)
    keys = sorted(by, key=lambda c: kinds[c] == "string")
    window = Window.partitionBy(*[col(c) for c in keys]).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def last_per_key(df: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """Row with the greatest ordinal per key."""
    return first_per_key(df, by, col(ordinal).desc())
