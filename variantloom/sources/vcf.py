"""Reading VCF text: lines, header definitions, sample names and records."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import takewhile

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions.labels import quoted, text_literal
from variantloom.names import ANN_FIELDS, KEY, MISSING
from variantloom.operators.ranking import last_per_key
from variantloom.session import small_side, written
from variantloom.sources.files import can_open, open_text


# Headers are short: one task opens this many files.
FILES_PER_TASK = 64
# Lines are counted in buckets of places; a bucket is hot beyond this and four times the mean.
BUCKETS = 4096
HOT_LINES = 200_000

# Tasks get these helpers with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Header:
    """INFO ids with their declared types, and the names of the ANN fields."""

    types: dict[str, str]
    ann_fields: list[str] = field(default_factory=lambda: list(ANN_FIELDS))


def widest(one: str, other: str) -> str:
    """The declared type that holds the values of both."""
    if one == other:
        return one
    return "Float" if {one, other} == {"Integer", "Float"} else "String"


def listed_fields(description: str) -> list[str]:
    """Field names that an ANN definition lists after its colon."""
    listing = description.split(":", 1)[-1].strip(" '\"")
    return [name.strip(" '\"") for name in listing.split("|")]


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, glob: str = "*.vcf*"
) -> DataFrame:
    """Lines of VCF files with their file and an ordinal that grows along each file.

    Large files are split; a line's place is (offset of its split, row within the split).
    `recursive` reads all files matching `glob` below the paths.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    text = reader.text([paths] if isinstance(paths, str) else list(paths))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ordinal"),
        F.col("value").alias("line"),
    )


def header_lines(lines: DataFrame) -> DataFrame:
    """`#` lines of every file (file, line), read from the start of each file only.

    On storage that Arrow cannot open, one pass over the text filters them instead.
    """
    # Local paths read "file:/x" in the metadata column and "file:///x" in the file list.
    files = [re.sub("^file:/+", "file:/", f) for f in lines.inputFiles()]
    if files and can_open(files[0]):
        listing = lines.sparkSession.createDataFrame([(f,) for f in files], "file string")
        return listing.repartition(1 + len(files) // FILES_PER_TASK).mapInPandas(leading_lines, "file string, line string")
    return lines.filter(F.col("line").startswith("#")).select("file", "line")


def headers_of(files: DataFrame) -> DataFrame:
    """`#` lines of listed files (file), read where they are listed: file, line. No path passes the driver.

    On storage that Arrow cannot open, Spark reads the text of the files by their paths instead.
    """
    first = files.select("file").limit(1).collect()
    if not first or can_open(first[0]["file"]):
        dealt = files.select("file").repartition("file")
        return dealt.mapInPandas(leading_lines, "file string, line string")
    return header_lines(read_lines(files.sparkSession, [row["file"] for row in files.select("file").collect()]))


def leading_lines(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """The `#` lines of each listed file, up to the first record."""
    for batch in batches:
        for path in batch["file"]:
            with open_text(path) as text:
                found = list(takewhile(lambda line: line.startswith("#"), text))
            yield pd.DataFrame({"file": path, "line": [line.rstrip("\r\n") for line in found]})


def info_definitions(lines: DataFrame) -> DataFrame:
    """Distinct INFO definitions: id, number, type, description."""
    line = F.col("line")

    def part(pattern: str) -> Column:
        return F.regexp_extract(line, pattern, 1)

    return (
        lines.filter(line.startswith("##INFO=<"))
        .select(
            part(r"[<,]ID=([^,>]+)").alias("id"),
            part(r"[<,]Number=([^,>]+)").alias("number"),
            part(r"[<,]Type=([^,>]+)").alias("type"),
            part(r'Description="(.*)"').alias("description"),
        )
        .distinct()
    )


def contig_lengths(lines: DataFrame) -> DataFrame:
    """CHROM, LENGTH from the contig definitions."""
    line = F.col("line")
    return (
        lines.filter(line.startswith("##contig=<"))
        .select(
            F.regexp_extract(line, r"[<,]ID=([^,>]+)", 1).alias("CHROM"),
            F.regexp_extract(line, r"[<,]length=(\d+)", 1).try_cast("bigint").alias("LENGTH"),
        )
        .filter("LENGTH IS NOT NULL")
        .groupBy("CHROM")
        .agg(F.max("LENGTH").alias("LENGTH"))
    )


def load_header(lines: DataFrame, seen: Iterable[str] = ()) -> Header:
    """Collect the distinct INFO definitions (a few hundred rows) to fix the column names.

    Files that disagree about a type get the widest; ANN fields are those of all layouts. Ids that
    are `seen` in records but declared nowhere are texts.
    """
    rows = info_definitions(lines).orderBy("id", "type", "description").collect()
    types: dict[str, str] = {}
    fields: list[str] = []
    for row in rows:
        types[row["id"]] = widest(types.get(row["id"], row["type"]), row["type"])
        if row["id"] == "ANN" and "|" in row["description"]:
            fields += [name for name in listed_fields(row["description"]) if name not in fields]
    for name in sorted(set(seen) - set(types)):
        types[name] = "String"
    return Header(types, fields or list(ANN_FIELDS))


def annotation_layouts(lines: DataFrame) -> DataFrame:
    """file, layout: the ANN field names of each file that lists them."""
    text = F.regexp_extract("line", r'Description="(.*)"', 1)
    listed = F.trim(F.substring(text, F.locate(":", text) + 1, F.length(text)), F.lit(" '\""))
    names = F.transform(F.split(listed, r"\|"), lambda name: F.trim(name, F.lit(" '\"")))
    defined = lines.filter(F.col("line").rlike("^##INFO=<(.*,)?ID=ANN[,>]") & text.contains("|"))
    return defined.groupBy("file").agg(F.max(names).alias("layout"))


def info_keys(lines: DataFrame) -> DataFrame:
    """file, id: the INFO keys that the records of each file hold; one pass over the text."""
    records = lines.filter(~F.col("line").startswith("#") & (F.col("line") != ""))
    info = records.select("file", F.get(F.split("line", "\t", 9), F.lit(7)).alias("info"))
    keys = F.transform(F.split("info", ";"), lambda item: F.substring_index(item, "=", 1))
    return info.select("file", F.explode(F.array_distinct(keys)).alias("id")).filter(~F.col("id").isin("", MISSING)).distinct()


def sample_names(lines: DataFrame) -> DataFrame:
    """One row per file: the first sample of the column line, else the file name."""
    fields = F.split("line", "\t")
    return lines.filter(F.col("line").startswith("#CHROM")).select(
        "file",
        F.coalesce(
            F.get(fields, F.lit(9)), F.element_at(F.split("file", "/"), -1)
        ).alias("SAMPLE"),
    ).groupBy("file").agg(F.min("SAMPLE").alias("SAMPLE"))


def info_map(info: Column) -> Column:
    """INFO text as a map; a flag reads "True", "." reads NULL, a repeated key keeps its last value."""

    def key_of(item: Column) -> Column:
        return F.substring_index(item, "=", 1)

    items = F.split(info, ";")
    keys = F.transform(items, key_of)
    backwards = F.reverse(keys)
    last_only = F.filter(
        items,
        lambda item, i: F.array_position(backwards, key_of(item)) == F.size(items) - i,
    )
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    text = F.when(unique, info).otherwise(F.array_join(last_only, ";"))
    return F.transform_values(
        F.str_to_map(text, F.lit(";"), F.lit("=")),
        lambda _, value: F.nullif(F.coalesce(value, F.lit("True")), F.lit(MISSING)),
    )


def gathered(lines: DataFrame, scope: Sequence[str] = ("file",), hot_lines: int = HOT_LINES) -> DataFrame:
    """Record lines with their CHROM, POS and REF, those of one place in one partition.

    The whole text of a record takes less room in a shuffle than its columns, and what follows per variant needs no
    other. Where lines of one place are very many, a record that repeats is cut to its last line first.
    """
    kept = lines.columns
    fields = F.split("line", "\t", 6)
    named = {"CHROM": F.get(fields, F.lit(0)), "POS": F.get(fields, F.lit(1)).cast("bigint"), "REF": F.get(fields, F.lit(3))}
    places = lines.filter(~F.col("line").startswith("#") & (F.col("line") != "")).select(*kept, *[c.alias(n) for n, c in named.items()])
    place = [*scope, *named]
    bucket = F.pmod(F.xxhash64(*place), F.lit(BUCKETS))
    counts = {row["bucket"]: row["count"] for row in places.groupBy(bucket.alias("bucket")).count().collect()}
    hot = [b for b, n in counts.items() if n > hot_lines + 4 * sum(counts.values()) / BUCKETS]
    if hot:
        repeated = places.filter(bucket.isin(hot)).withColumn("ALT", F.get(fields, F.lit(4)))
        last = last_per_key(repeated, [*scope, *KEY], "ordinal").select(places.columns)
        places = places.filter(~bucket.isin(hot)).unionByName(last)
    return places.repartition(*place)


def parse_records(lines: DataFrame, info_ids: Iterable[str]) -> DataFrame:
    """Records of VCF lines: the fixed columns plus the asked INFO ids.

    Needs columns file, ordinal, line; other columns (e.g. SAMPLE) are kept. Lines may be `gathered`.
    """
    fixed_names = ("CHROM", "POS", "REF")
    kept = [c for c in lines.columns if c not in ("line", *fixed_names)]
    known = [c for c in fixed_names if c in lines.columns]
    records = lines.filter(~F.col("line").startswith("#") & (F.col("line") != "")).select(
        *kept, *known, F.split("line", "\t", 9).alias("_f")
    )

    def at(i: int, name: str = "") -> Column:
        return F.col(name) if name in known else F.get("_f", F.lit(i))

    fixed = records.select(
        *kept,
        at(0, "CHROM").alias("CHROM"),
        at(1, "POS").cast("bigint").alias("POS"),
        F.nullif(at(2), F.lit(MISSING)).alias("ID"),
        at(3, "REF").alias("REF"),
        at(4).alias("ALT"),
        at(5).try_cast("double").alias("QUAL"),
        F.nullif(at(6), F.lit(MISSING)).alias("FILTER"),
        info_map(at(7)).alias("_info"),
    )

    ids = [f"_info[{text_literal(key)}] AS {quoted(key)}" for key in info_ids]
    return fixed.selectExpr(*[quoted(c) for c in fixed.columns if c != "_info"], *ids)


def with_samples(lines: DataFrame, headers: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Add to every line the SAMPLE of its file and, from the keys `seen`, whether the file has annotations.

    Files whose ANN fields are laid out differently also bring their layout along.
    """
    named = sample_names(headers)
    if seen is not None:
        found = seen.filter("id = 'ANN'").select("file", F.lit(True).alias("_annotated"))
        named = named.join(found, "file", "full").withColumn("_annotated", F.coalesce("_annotated", F.lit(False)))
        layouts = annotation_layouts(headers)
        if layouts.select("layout").distinct().limit(2).count() > 1:
            named = named.join(layouts.withColumnRenamed("layout", "_layout"), "file", "left")
    out = lines.join(small_side(named), "file", "left")
    if seen is not None:
        out = out.withColumn("_annotated", F.coalesce("_annotated", F.lit(False)))
    return out.withColumn("SAMPLE", F.coalesce("SAMPLE", F.element_at(F.split("file", "/"), -1)))


def read_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: Header | None = None,
    recursive: bool = False,
    glob: str = "*.vcf*",
    together: bool = False,
) -> tuple[DataFrame, Header]:
    """Records of one or many VCF files, one row per record, with their SAMPLE.

    Headers are read from the start of each file; a first pass over the text finds the INFO keys of
    every file, declared or not. Pass known definitions as `header` to keep only the wanted INFO ids.
    `together` brings the records of a place in a file into one partition.
    """
    lines = read_lines(spark, paths, recursive, glob)
    headers = written(header_lines(lines), "headers")
    seen = written(info_keys(lines), "keys")
    header = header or load_header(headers, [row["id"] for row in seen.select("id").distinct().collect()])
    named = with_samples(lines, headers, seen)
    return parse_records(gathered(named) if together else named, list(header.types)), header
