"""End-to-end analyses: one sample, comparisons, cohort maintenance, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions.labels import quoted
from variantloom.names import SORT_KEY
from variantloom.operators import cohort as C
from variantloom.operators.filters import panel_filter, text_filter
from variantloom.operators.flatten import Ranks, flatten_vcf
from variantloom.operators.intervals import annotate_genes, depth_runs, depth_summary, interval_intersect
from variantloom.operators.venn import compare_samples, venn_place
from variantloom.session import written
from variantloom.sources import sinks
from variantloom.sources.files import list_files, select_sample_files
from variantloom.sources.tables import read_cohort_parquet, read_panel
from variantloom.sources.vcf import Header, header_lines, read_lines, sample_names


def annotate_report(
    report: DataFrame, calls: DataFrame, with_carriers: bool = False, n_samples: int | None = None
) -> DataFrame:
    """A report with cohort frequencies and, if asked, the carriers of each variant.

    The report is written once: its size checks and both joins read that, not its lineage.
    """
    report = written(report, "report")
    out = C.annotate_frequencies(report, C.cohort_frequencies(calls, n_samples=n_samples))
    if with_carriers:
        columns = [quoted(c) for c in out.columns]
        out = out.join(C.carriers(report, calls), SORT_KEY, "left").select(*columns, "PATS_WITH_VARIANTS")
    return out


def single(
    variants: DataFrame,
    panel: DataFrame,
    cohort: DataFrame | None = None,
    with_carriers: bool = False,
    n_samples: int | None = None,
) -> DataFrame:
    """One sample's variants in the panel's genes, annotated from the cohort if given."""
    kept = panel_filter(variants, panel)
    return kept if cohort is None else annotate_report(kept, cohort, with_carriers, n_samples)


def compare(
    tables: Mapping[str, DataFrame],
    place: str | None = None,
    panel: DataFrame | None = None,
    rules: Sequence[str] = (),
    separate: Sequence[str] | None = None,
) -> DataFrame:
    """Two or three samples: comparison, Venn region, panel, text rules, in this order."""
    out = venn_place(compare_samples(tables, separate), place, list(tables))
    if panel is not None:
        out = panel_filter(out, panel)
    return text_filter(out, rules)


def sample_tables(variants: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The named samples of a long variant table, each as its own table."""
    return {n: variants.filter(F.col("SAMPLE") == n).drop("SAMPLE") for n in names}


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as the file metadata of Spark names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def read_samples(
    spark: SparkSession, paths: Sequence[str], prioritized: bool | Ranks = True, header: Header | None = None
) -> dict[str, DataFrame]:
    """One variant table per VCF file, in the given order, keyed by sample; all files are read together.

    Names come from the headers, all read in one job. Two files with one sample name are an error, not one table.
    """
    headers = sample_names(header_lines(read_lines(spark, list(paths)))).collect()  # a row per given file
    held = {unquote(row["file"]): row["SAMPLE"] for row in headers}
    named: dict[str, str] = {}
    for path in paths:
        place = qualified(spark, path)
        found = sorted({name for file, name in held.items() if file == place or file.startswith(place + "/")})
        name = found[0] if found else path.rsplit("/", 1)[-1]
        if len(found) > 1 or name in named:
            raise ValueError(f"{path}: one file per sample is needed, {name} comes twice")
        named[name] = path
    variants = written(flatten_vcf(spark, list(paths), prioritized, header), "samples")
    return sample_tables(variants, list(named))


def single_report(
    spark: SparkSession, vcf: str, panel: str, out: str, cohort: str | None = None, with_carriers: bool = False
) -> None:
    """Panel report of one VCF file, written as tables."""
    calls = read_cohort_parquet(spark, cohort) if cohort else None
    n_samples = cohort_size(spark, cohort) if cohort else None
    result = single(flatten_vcf(spark, vcf), read_panel(spark, panel), calls, with_carriers, n_samples)
    if calls is None:
        sinks.write_report(result, out)
    else:
        sinks.write_annotated_report(result, out)


def comparison_report(
    spark: SparkSession,
    vcfs: Sequence[str],
    out: str,
    place: str | None = None,
    panel: str | None = None,
    rules: Sequence[str] = (),
) -> None:
    """Report of two or three VCF files; without place, panel and rules it shows all differences."""
    genes = read_panel(spark, panel) if panel else None
    result = compare(read_samples(spark, vcfs), place, genes, rules)
    sinks.write_report(result, out)


def parse_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    out: str,
    file_type: str = "parquet",
    prioritized: bool | Ranks = True,
    recursive: bool = False,
    partition_by: Sequence[str] = (),
    glob: str = "*.vcf*",
) -> None:
    """Flatten VCF files or a folder to CSV or parquet."""
    variants = flatten_vcf(spark, paths, prioritized, recursive=recursive, glob=glob, together=True)
    if file_type == "csv":
        sinks.write_flat_csv(variants, out)
    elif file_type == "parquet":
        sinks.write_flat_parquet(variants, out, partition_by)
    else:
        raise ValueError("file_type is 'csv' or 'parquet'")


def cohort_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there; a cohort that cannot be read is an error where it is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def build_cohort(
    spark: SparkSession,
    folder: str,
    cohort: str,
    suffix: str,
    prioritized: bool | Ranks = True,
    header: Header | None = None,
    ending: str = "final.vcf",
) -> int:
    """Ingest every sample file of a folder that the cohort lacks; returns the number of files.

    Sample files are those whose name has the ending.
    """
    # What is known comes from the headers' sample names, also of samples without a single variant.
    files = list_files(spark, folder).filter(F.lower("path").endswith(ending))
    known = []
    if cohort_exists(spark, sinks.samples_path(cohort)):
        registered = spark.read.parquet(sinks.samples_path(cohort))
        files = files.join(registered.select("path"), "path", "left_anti")
        known.append(registered.select("SAMPLE"))
    if cohort_exists(spark, cohort):
        known.append(read_cohort_parquet(spark, cohort).select("SAMPLE"))
    fresh = [row["path"] for row in files.select("path").collect()]
    if not fresh:
        return 0
    names = written(sample_names(header_lines(read_lines(spark, fresh))), "names").withColumnRenamed("file", "path")
    chosen = written(
        select_sample_files(files, suffix, reduce(DataFrame.union, known) if known else None, ending, names), "chosen"
    )
    paths = [row["path"] for row in chosen.select("path").collect()]
    if paths:
        variants = flatten_vcf(spark, paths, prioritized, header)
        sinks.write_cohort(C.to_calls(variants), cohort)
        sinks.register_samples(chosen, cohort)
    return len(paths)


def cohort_size(spark: SparkSession, cohort: str) -> int | None:
    """Number of samples of a cohort, those without variants included; None if none is registered.

    Samples that were added without a file count by their calls.
    """
    if not cohort_exists(spark, sinks.samples_path(cohort)):
        return None
    registered = spark.read.parquet(sinks.samples_path(cohort)).select("SAMPLE")
    return registered.union(read_cohort_parquet(spark, cohort).select("SAMPLE")).distinct().count()


def add_sample(spark: SparkSession, calls: DataFrame, cohort: str) -> None:
    """Add one sample's calls; fails if the cohort already has the sample."""
    names = [row["SAMPLE"] for row in calls.select("SAMPLE").distinct().limit(2).collect()]
    if len(names) != 1:
        raise ValueError("calls must belong to exactly one sample")
    if cohort_exists(spark, cohort):
        same = read_cohort_parquet(spark, cohort).filter(F.col("SAMPLE") == names[0])
        if not same.isEmpty():
            raise ValueError(f"sample {names[0]} is already in the cohort")
    sinks.write_cohort(calls, cohort)


def coverage(
    reads: DataFrame,
    genes: DataFrame,
    panel: DataFrame | None = None,
    lengths: DataFrame | None = None,
    by: Sequence[str] = ("CHROM",),
    **options,
) -> DataFrame:
    """Depth runs of the reads, cut to the panel's intervals if given, with gene and exon names.

    `by` names the file or sample column first when several are analysed together.
    """
    runs = depth_runs(reads, lengths, by)
    if panel is not None:
        runs = interval_intersect(runs, panel, **options)
    return annotate_genes(runs, genes, **options)


def coverage_summary(
    reads: DataFrame, genes: DataFrame, level: str = "GENE", by: Sequence[str] = ("CHROM",), **options
) -> DataFrame:
    groups = [c for c in by if c != "CHROM"]
    return depth_summary(coverage(reads, genes, by=by, **options), level, groups)
