"""Writing variant tables, cohorts, reports and depth summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantloom.functions.labels import col
from variantloom.operators.flatten import finalize_strings
from variantloom.operators.intervals import depth_summary
from variantloom.operators.report import (
    annotated_projection,
    link_columns,
    report_projection,
    sort_report,
)
from variantloom.operators.stats import general_stats
from variantloom.session import freed_shuffles


def write_flat_csv(variants: DataFrame, path: str) -> None:
    """Variant table as CSV with "." for missing cells."""
    with freed_shuffles(variants.sparkSession):
        finalize_strings(variants).write.csv(path, header=True)


def write_flat_parquet(
    variants: DataFrame, path: str, partition_by: Sequence[str] = (), append: bool = False
) -> None:
    """Variant table as snappy parquet; without `append`, partitions that get rows are replaced.

    Rows of a partition are brought together so that small ones make one file, and AQE
    splits those that are too large for one task.
    """
    if partition_by:
        variants = variants.hint("rebalance", *[col(c) for c in partition_by])
    writer = variants.write.option("compression", "snappy").partitionBy(*partition_by)
    with freed_shuffles(variants.sparkSession):
        if append:
            writer.mode("append").parquet(path)
        elif partition_by:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        else:
            writer.mode("overwrite").parquet(path)


def write_cohort(calls: DataFrame, path: str) -> None:
    """Long cohort partitioned by SAMPLE and PART; writing a part of a sample again replaces it.

    Without a PART column the sample is one part.
    """
    parts = calls if "PART" in calls.columns else calls.withColumn("PART", F.lit("whole"))
    write_flat_parquet(parts, path, ["SAMPLE", "PART"])


def samples_path(cohort: str) -> str:
    """Where the samples of a cohort are registered: those without variants have no calls."""
    return cohort.rstrip("/") + "_samples"


def register_samples(samples: DataFrame, cohort: str) -> None:
    """Add SAMPLE and path of ingested files; registering a file again changes nothing that counts."""
    samples.select("SAMPLE", "path").write.mode("append").parquet(samples_path(cohort))


def write_cohort_by_chrom(table: DataFrame, path: str) -> None:
    """Sorted CSVs in one folder per chromosome (BY_CHROM=...), fractions with 5 places.

    Range partitioning gives a large chromosome several ordered files.
    """
    fractions = [f.name for f in table.schema.fields if isinstance(f.dataType, T.FractionalType)]
    text = table.withColumns({c: F.format_string("%.5f", col(c)) for c in fractions})
    (
        text.repartitionByRange("CHROM", "POS")
        .sortWithinPartitions("CHROM", "POS")
        .withColumn("BY_CHROM", F.col("CHROM"))
        .write.partitionBy("BY_CHROM")
        .csv(path, header=True)
    )


def write_report(variants: DataFrame, path: str) -> None:
    """Report as two tables below `path`: data (ordered columns, links) and statistics."""
    data = report_projection(variants)
    if {"RSID", "GENE_NAME"} <= set(data.columns):
        data = link_columns(data)
    sort_report(data).write.csv(f"{path}/data", header=True)
    write_statistics(variants, path)


def write_annotated_report(variants: DataFrame, path: str) -> None:
    """Report with cohort frequencies (and carriers, if present) as data and statistics."""
    data = annotated_projection(variants)
    if {"RSID", "GENE_NAME"} <= set(data.columns):
        data = link_columns(data, any_identifier=True)
    lists = [c for c, kind in data.dtypes if kind.startswith("array")]
    data.withColumns({c: F.array_join(col(c), ",") for c in lists}).write.csv(f"{path}/data", header=True)
    write_statistics(variants, path)


def write_statistics(variants: DataFrame, path: str) -> None:
    stats = general_stats(variants)
    if stats is not None:
        stats.orderBy(*stats.columns[:-1]).write.csv(f"{path}/statistics", header=True)


def write_depth_reports(coverage: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Depth summaries per gene and per exon."""
    depth_summary(coverage, "GENE", by).write.csv(f"{path}/coverage_per_gene", header=True)
    depth_summary(coverage, "EXON", by).write.csv(f"{path}/coverage_per_exon", header=True)
