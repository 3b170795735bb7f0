"""Row filters on variant tables: gene panel, text rules, Venn region, point lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.functions.labels import col
from variantloom.names import MISSING
from variantloom.session import BROADCAST_ROWS, small_side


def panel_filter(
    df: DataFrame, panel: DataFrame, gene: str = "GENE_NAME", max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose gene is in the panel (column GeneSymbol); exact, case-sensitive."""
    genes = small_side(panel.select("GeneSymbol").distinct(), max_broadcast_rows)
    return df.join(genes, col(gene) == F.col("GeneSymbol"), "left_semi")


def panel_order(df: DataFrame, panel_positions: DataFrame, gene: str = "GENE_NAME") -> DataFrame:
    """Rows of panel genes sorted by the gene's PANEL_POSITION, as a panel report lists them."""
    places = panel_positions.groupBy("GeneSymbol").agg(F.min("PANEL_POSITION").alias("PANEL_POSITION"))
    kept = df.join(small_side(places), col(gene) == F.col("GeneSymbol")).drop("GeneSymbol")
    return kept.orderBy("PANEL_POSITION", "CHROM", "POS", "REF", "ALT")


def text_filter(df: DataFrame, rules: Sequence[str] = ()) -> DataFrame:
    """Drop rows matching any rule "COLUMN PATTERN"; "COLUMN Empty" drops rows without a value."""
    for rule in rules:
        parts = rule.split()
        if len(parts) != 2:
            raise ValueError(f"a rule is 'COLUMN PATTERN', got {rule!r}")
        name, pattern = parts
        text = F.coalesce(col(name).cast("string"), F.lit(MISSING))
        if pattern == "Empty":
            df = df.filter(~text.isin("", MISSING))
        else:
            df = df.filter(~text.rlike(pattern))
    return df


def point_lookup(df: DataFrame, chrom: str, pos: int) -> DataFrame:
    """Variants at one position; the predicate reaches the parquet scan."""
    return df.filter((F.col("CHROM") == chrom) & (F.col("POS") == pos))


def chromosome_slice(df: DataFrame, chrom: str) -> DataFrame:
    """One chromosome; prunes partitions of a table partitioned by CHROM."""
    return df.filter(F.col("CHROM") == chrom)
