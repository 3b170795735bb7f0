"""The cohort: long table of calls, frequencies, labels, matrix, and report annotation.

The store is long (SAMPLE, CHROM, POS, REF, ALT, ZIGOSITY, GENE_NAME, ...); frequencies
are kept as sums per variant so that batches merge without re-reading old calls.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import labels as L
from variantloom.functions.labels import col
from variantloom.names import KEY, MISSING, SORT_KEY
from variantloom.session import BROADCAST_ROWS, is_small

CALL_COLUMNS = ["SAMPLE", *KEY, "ZIGOSITY", "GENE_NAME", "HGVS.C", "HGVS.P"]
LABEL_COLUMNS = ["GENE_NAME", "HGVS.C", "HGVS.P"]
FREQUENCIES = ["VARDB_FREQ", "ALLELE_FREQ"]
SEPARATOR = " | "


def to_calls(variants: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The cohort columns of a variant table, and `extra` ones; an absent genotype label is "UNKWN"."""
    have = set(variants.columns)
    out = []
    for name in CALL_COLUMNS:
        if name in have:
            value = col(name)
        else:
            value = F.lit("UNKWN" if name == "ZIGOSITY" else None).cast("string")
        out.append(value.alias(name))
    return variants.select(*out, *[col(c) for c in extra])


def sample_count(calls: DataFrame) -> Column:
    """Number of samples as a scalar subquery (reads only the SAMPLE column)."""
    return calls.select(F.countDistinct("SAMPLE")).scalar()


def one_call_per_sample(calls: DataFrame) -> DataFrame:
    """Key, SAMPLE and the largest dosage, for tables with a row per annotation."""
    return calls.groupBy(*KEY, "SAMPLE").agg(F.max(L.dosage(F.col("ZIGOSITY"))).alias("_dosage"))


def carrier_stats(calls: DataFrame, unique: bool = False) -> DataFrame:
    """Key, N_CARRIERS, N_ALLELES: sums that merge across batches of samples.

    `unique=True` (one row per sample and variant) needs a single shuffle.
    Calls without a genotype (NULL or ".") do not count.
    """
    called = calls.filter(F.col("ZIGOSITY").isNotNull() & (F.col("ZIGOSITY") != MISSING))
    if unique:
        rows = called.select(*KEY, L.dosage(F.col("ZIGOSITY")).alias("_dosage"))
    else:
        rows = one_call_per_sample(called)
    return rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("N_CARRIERS"), F.sum("_dosage").cast("bigint").alias("N_ALLELES")
    )


def with_frequencies(stats: DataFrame, n_samples: Column | int) -> DataFrame:
    """Add FREQ (carriers / samples) and ALLELE_FREQ (alleles / 2 samples)."""
    n = (F.lit(n_samples) if isinstance(n_samples, int) else n_samples).cast("double")
    return stats.withColumns(
        {"FREQ": F.col("N_CARRIERS") / n, "ALLELE_FREQ": F.col("N_ALLELES") / (n * 2)}
    )


def cohort_frequencies(calls: DataFrame, unique: bool = False, n_samples: int | None = None) -> DataFrame:
    """Frequencies of a cohort; `n_samples` also counts samples without variants, which `calls` cannot."""
    return with_frequencies(carrier_stats(calls, unique), sample_count(calls) if n_samples is None else n_samples)


def merge_stats(*batches: DataFrame) -> DataFrame:
    """Add up the sums of several batches of distinct samples."""
    united = reduce(lambda a, b: a.unionByName(b), batches)
    return united.groupBy(*KEY).agg(
        F.sum("N_CARRIERS").alias("N_CARRIERS"), F.sum("N_ALLELES").alias("N_ALLELES")
    )


def label_set(pieces: Column) -> Column:
    """Distinct labels over rows that each hold an array; sets are merged map-side."""
    return F.array_distinct(F.flatten(F.collect_set(pieces)))


def label_pieces(name: str) -> Column:
    """Labels of a cell; those of an earlier cohort are already joined."""
    return F.split(col(name), r" \| ")


def joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(labels), SEPARATOR)


def cohort_labels(calls: DataFrame, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Per variant, the distinct labels over all samples, sorted and " | "-joined."""
    return calls.groupBy(*KEY).agg(*[joined(label_set(label_pieces(c))).alias(c) for c in columns])


def cohort_table(calls: DataFrame, unique: bool = False) -> DataFrame:
    """Key, labels, N_CARRIERS, N_ALLELES, FREQ and ALLELE_FREQ of every variant, in one pass.

    Without `unique` the rows of a sample's variant are reduced to one first.
    """
    called = F.col("ZIGOSITY").isNotNull() & (F.col("ZIGOSITY") != MISSING)
    rows = calls.select(
        *KEY,
        "SAMPLE",
        F.when(called, L.dosage(F.col("ZIGOSITY"))).alias("_dosage"),
        *[label_pieces(c).alias(c) for c in LABEL_COLUMNS],
    )
    if not unique:
        rows = rows.groupBy(*KEY, "SAMPLE").agg(
            F.max("_dosage").alias("_dosage"), *[label_set(col(c)).alias(c) for c in LABEL_COLUMNS]
        )
    table = rows.groupBy(*KEY).agg(
        *[joined(label_set(col(c))).alias(c) for c in LABEL_COLUMNS],
        F.count("_dosage").alias("N_CARRIERS"),
        F.coalesce(F.sum("_dosage"), F.lit(0)).cast("bigint").alias("N_ALLELES"),
    )
    return with_frequencies(table, sample_count(calls))


def cohort_matrix(calls: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Variant x sample table of genotype labels for the listed samples (export form).

    Every call must belong to a listed sample; anything else fails instead of vanishing.
    FREQ and ALLELE_FREQ are over the listed samples.
    """
    listed = F.col("SAMPLE").isin(list(samples))
    known = calls.withColumn(
        "SAMPLE",
        F.when(listed, F.col("SAMPLE")).otherwise(
            F.raise_error(F.concat(F.lit("sample not listed: "), F.col("SAMPLE")))
        ),
    )
    cells = known.groupBy(*KEY).pivot("SAMPLE", list(samples)).agg(F.max("ZIGOSITY"))
    present = [F.when(F.coalesce(col(s), F.lit(MISSING)) != MISSING, 1).otherwise(0) for s in samples]
    alleles = [F.coalesce(L.dosage(col(s)), F.lit(0)) for s in samples]
    n = F.lit(float(len(samples)))
    return cells.select(
        *KEY,
        (reduce(lambda a, b: a + b, alleles) / (n * 2)).alias("ALLELE_FREQ"),
        (reduce(lambda a, b: a + b, present) / n).alias("FREQ"),
        *[F.coalesce(col(s), F.lit(MISSING)).alias(s) for s in samples],
    )


def matrix_to_calls(matrix: DataFrame, samples: Sequence[str]) -> DataFrame:
    """A wide cohort (one column per sample) back to long calls."""
    ids = [c for c in matrix.columns if c not in samples and c not in ("FREQ", "ALLELE_FREQ")]
    long = matrix.unpivot([col(c) for c in ids], [col(s) for s in samples], "SAMPLE", "ZIGOSITY")
    return long.filter(F.col("ZIGOSITY").isNotNull() & (F.col("ZIGOSITY") != MISSING))


def of_report(table: DataFrame, report: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A big cohort table cut to the report's variants, without shuffling it, if the report is small."""
    keys = report.select(*KEY)
    if is_small(keys, max_broadcast_rows):
        return table.join(F.broadcast(keys.distinct()), KEY, "left_semi")
    return table


def annotate_frequencies(report: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Left join of a report with the cohort: VARDB_FREQ and ALLELE_FREQ, to 6 places."""
    kept = [c for c in report.columns if c not in ("FREQ", "ALLELE_FREQ", "VARDB_FREQ")]
    wanted = of_report(frequencies, report).select(
        *KEY,
        F.round(F.col("FREQ").cast("double"), 6).alias("VARDB_FREQ"),
        F.round(F.col("ALLELE_FREQ").cast("double"), 6).alias("ALLELE_FREQ"),
    )
    joined_rows = report.join(wanted.withColumnsRenamed({c: f"_{c}" for c in FREQUENCIES}), SORT_KEY, "left")
    return joined_rows.select(*[col(c) for c in kept], *[col(f"_{c}").alias(c) for c in FREQUENCIES])


def carriers(report: DataFrame, calls: DataFrame) -> DataFrame:
    """Per report variant, the sorted list of cohort samples that carry it (may be empty).

    The list is the report's cell, at most one name per cohort sample; the sets are
    merged map-side.
    """
    called = calls.filter(F.col("ZIGOSITY").isNotNull() & (F.col("ZIGOSITY") != MISSING))
    names = (
        of_report(called, report)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("SAMPLE")).alias("_names"))
    )
    listed = report.select(*KEY).distinct().join(names, SORT_KEY, "left")
    return listed.select(
        *KEY,
        F.coalesce("_names", F.array().cast("array<string>")).alias("PATS_WITH_VARIANTS"),
    )
