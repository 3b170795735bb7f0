"""From VCF records to one row per variant (or per variant and annotation)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions import labels as L
from variantloom.functions.labels import col, quoted, text_literal
from variantloom.names import (
    KEY,
    PER_ALLELE_COLUMNS,
    PER_ALLELE_PREFIXES,
)
from variantloom.operators.ranking import first_per_key, last_per_key
from variantloom.sources.vcf import Header, read_vcf

Ranks = Mapping[str, int]


def dedupe_variants(df: DataFrame, by: Sequence[str] = ("file", *KEY), ordinal: str = "ordinal") -> DataFrame:
    """Keep the last record of each variant within a file."""
    return last_per_key(df, by, ordinal)


def is_per_allele(name: str) -> bool:
    return name in PER_ALLELE_COLUMNS or name.startswith(PER_ALLELE_PREFIXES)


def split_multiallelic(
    df: DataFrame, columns: Sequence[str] | None = None, mode: str = "all"
) -> DataFrame:
    """One row per alternate allele; per-allele columns follow their allele.

    mode "all" splits every allele; "first_rest" splits only the first from the others.
    A column with a single value keeps it on every row. Rows that were split lose
    parentheses in their per-allele columns. Adds RAW_ALT and ALLELE_INDEX.
    """
    if mode not in ("all", "first_rest"):
        raise ValueError("mode is 'all' or 'first_rest'")
    if columns is None:
        columns = [c for c in df.columns if is_per_allele(c)]
    limit = -1 if mode == "all" else 2
    exploded = df.withColumn("RAW_ALT", F.col("ALT")).select(
        "*", F.posexplode(F.split("ALT", ",", limit)).alias("ALLELE_INDEX", "_allele")
    )

    def of_allele(name: str) -> str:
        text = f"CAST({quoted(name)} AS STRING)"
        parts = f"split({text}, ',', {limit})"
        own = f"CASE WHEN size({parts}) <= 1 THEN {text} ELSE get({parts}, ALLELE_INDEX) END"
        stripped = f"trim(regexp_replace({own}, '[()]', ''))"
        return f"CASE WHEN contains(RAW_ALT, ',') THEN {stripped} ELSE {text} END AS {quoted(name)}"

    split = set(columns)
    out = [
        "_allele AS ALT" if c == "ALT" else of_allele(c) if c in split else quoted(c) for c in df.columns
    ]
    return exploded.selectExpr(*out, "RAW_ALT", "ALLELE_INDEX")


def annotation_fields(parts: str, ann_fields: Sequence[str], layout: bool = False) -> list[str]:
    """SQL for the named fields of a split annotation entry; with `layout`, by the row's own `_layout`."""
    if layout:
        fixed = [f"coalesce(array_position(_layout, {text_literal(name)}) - 1, {i})" for i, name in enumerate(ann_fields)]
        own = [f"CAST({at} AS INT)" for at in fixed]
        return [f"CASE WHEN {at} >= 0 THEN nullif(get({parts}, {at}), '') END AS {quoted(name)}" for at, name in zip(own, ann_fields)]
    return [f"nullif(get({parts}, {i}), '') AS {quoted(name)}" for i, name in enumerate(ann_fields)]


def explode_annotations(df: DataFrame, ann_fields: Sequence[str]) -> DataFrame:
    """One row per annotation of a record, named columns; records without annotation drop out.

    Where a column `_annotated` says that a file has no annotations at all, its records stay.
    """
    rest = [quoted(c) for c in df.columns if c != "ANN"]
    entries = F.split("ANN", ",")
    if "_annotated" in df.columns:
        entries = F.when(F.col("_annotated"), entries).otherwise(F.array(F.lit(None).cast("string")))
    exploded = df.select(*rest, F.posexplode(entries).alias("ANN_INDEX", "_entry"))
    kept = [quoted(c) for c in exploded.columns if c != "_entry"]
    parts = exploded.select(*kept, F.split("_entry", r"\|").alias("_parts"))
    return parts.selectExpr(*kept, *annotation_fields("_parts", ann_fields, "_layout" in df.columns))


def best_annotation(df: DataFrame, ann_fields: Sequence[str], ranks: Ranks | None = None) -> DataFrame:
    """The most severe annotation of each row, chosen inside the row (no explode, no shuffle).

    Rows without annotation stay, with `_severity` NULL.
    """
    rest = [quoted(c) for c in df.columns if c != "ANN"]

    # One step per transform: a lambda computes a repeated expression every time.
    def parts(entry: Column, i: Column) -> Column:
        effect = F.substring_index(F.substring_index(entry, "|", 2), "|", -1)
        return F.struct(
            F.substring_index(entry, "|", 1).alias("allele"),
            L.effect_term(effect).alias("term"),
            i.alias("i"),
            entry.alias("entry"),
        )

    def ranked(x: Column) -> Column:
        return F.struct(x["allele"], x["term"], L.term_rank(x["term"], ranks).alias("rank"), x["i"], x["entry"])

    def scored(x: Column) -> Column:
        order = L.severity_order(x["allele"], F.col("ALT"), x["term"], x["rank"])
        return F.struct(order.alias("order"), x["i"], x["entry"])

    entries = F.transform(F.transform(F.split("ANN", ","), parts), ranked)
    best = F.array_min(F.transform(entries, scored))
    chosen = df.select(*rest, best.alias("_best"))
    kept = [quoted(c) for c in chosen.columns if c != "_best"]
    parts = chosen.select(
        *kept, F.col("_best.order").alias("_severity"), F.split("_best.entry", r"\|").alias("_parts")
    )
    return parts.selectExpr(*kept, "_severity", *annotation_fields("_parts", ann_fields, "_layout" in df.columns))


def prioritize(
    df: DataFrame,
    by: Sequence[str] = KEY,
    ranks: Ranks | None = None,
    position: Sequence[str] = ("ANN_INDEX",),
) -> DataFrame:
    """One annotation per variant: own allele first, then severity, then input order."""
    annotation = F.col("Annotation")
    order = L.severity_order(
        F.col("Allele"), F.col("ALT"), L.effect_term(annotation), L.effect_rank(annotation, ranks)
    )
    return first_per_key(df, by, order.asc(), *[col(c).asc() for c in position])


def standardize(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Upper-case names, derived columns, and numbers for declared Float/Integer INFO ids."""
    declared = {name.upper(): kind for name, kind in types.items()}
    renamed = {"ANNOTATION": "EFFECT", "ANNOTATION_IMPACT": "IMPACT", "ID": "RSID"}
    out: list[Column] = []
    seen: set[str] = set()

    def add(value: Column, name: str) -> None:
        if name not in seen:
            seen.add(name)
            out.append(value.alias(name))

    upper = {c.upper() for c in df.columns}
    for name in df.columns:
        up = name.upper()
        value = col(name)
        if up == "HOM":
            add(L.zygosity(value.isNotNull()), "ZIGOSITY")
        elif up == "HET" and "HOM" in upper:
            continue
        elif up == "ESP6500_MAF":
            for i, group in enumerate(("EA", "AA", "ALL")):
                add(L.esp_frequency(value, i), f"ESP6500_MAF_{group}")
        elif up == "ESP6500_PH":
            add(L.polyphen_prediction(value), "POLYPHEN_PRED")
            add(L.polyphen_score(value), "POLYPHEN_SCORE")
        elif up == "HGVS.C":
            add(L.clean_hgvs_c(value), up)
        elif up == "HGVS.P":
            add(value, up)
            add(L.amino_change(value), "AMINOCHANGE")
        elif up == "CLINVAR_CLNSIG":
            add(L.clinvar_labels(value.cast("string")), up)
        elif declared.get(up) == "Float":
            add(L.to_double(value.cast("string")), up)
        elif declared.get(up) == "Integer":
            add(L.to_integer(value.cast("string")), up)
        else:
            add(value, renamed.get(up, up))
    return df.select(*out)


def flatten_records(
    records: DataFrame,
    header: Header,
    prioritized: bool | Ranks = True,
    mode: str = "all",
    scope: Sequence[str] = ("file",),
) -> DataFrame:
    """Records to a variant table: split alleles, annotations, last record wins, typed columns.

    `prioritized` keeps one annotation per variant (a mapping replaces the default ranks).
    The annotation is picked inside each record first, so only narrow rows are shuffled.
    Whether records are annotated is decided by file (column `_annotated`): within an annotated file
    those without annotation drop out; all records of other files stay, with NULL annotation fields.
    """
    annotated = "ANN" in records.columns
    ranks = prioritized if isinstance(prioritized, Mapping) else None
    rows = split_multiallelic(records, mode=mode)
    if annotated and prioritized:
        rows = best_annotation(rows, header.ann_fields, ranks)
    rows = dedupe_variants(rows, [*scope, "CHROM", "POS", "REF", "RAW_ALT", "ALLELE_INDEX"])
    if prioritized and annotated:
        by = [*scope, *KEY]
        kept = F.col("_severity").isNotNull()
        if "_annotated" in rows.columns:
            # A record of a file without annotations is a group of its own.
            rows = rows.withColumn("_own", F.when(~F.col("_annotated"), F.struct("ordinal", "ALLELE_INDEX")))
            kept, by = kept | ~F.col("_annotated"), [*by, "_own"]
        # Dropped only here: below the window the test would parse every line twice.
        rows = rows.filter(kept)
        rows = first_per_key(rows, by, F.col("_severity").asc(), F.col("ordinal").asc(), F.col("ALLELE_INDEX").asc())
    elif annotated:
        rows = explode_annotations(rows, header.ann_fields)
    helpers = {"file", "ordinal", "RAW_ALT", "ALLELE_INDEX", "ANN_INDEX", "_severity", "_annotated", "_layout", "_own", *scope} - {"SAMPLE"}
    return standardize(rows.drop(*helpers), header.types)


def flatten_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    prioritized: bool | Ranks = True,
    header: Header | None = None,
    recursive: bool = False,
    mode: str = "all",
    glob: str = "*.vcf*",
    together: bool = False,
) -> DataFrame:
    """One or many VCF files to one variant table with a SAMPLE column.

    `together` shuffles the text of the records once instead of their columns twice, which takes less
    disk where most columns are wanted.
    """
    records, header = read_vcf(spark, paths, header, recursive, glob, together)
    return flatten_records(records, header, prioritized, mode)


def finalize_strings(df: DataFrame) -> DataFrame:
    """Export form: every cell text, missing ".", POS a number."""
    return df.select(
        *[
            F.col("POS").cast("bigint").alias("POS") if c == "POS" else L.export_text(col(c)).alias(c)
            for c in df.columns
        ]
    )
