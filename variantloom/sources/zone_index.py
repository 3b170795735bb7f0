"""Sorted variant files with an index that names the files to open: zone maps for positions, Bloom bits for identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions.labels import col

PLACE = ["CHROM", "POS"]
# Bits of a Bloom slice (a Spark bitmap), values that a slice takes, and bits set for each.
SLICE_BITS = 32_768
SLICE_VALUES = 3_000
HASHES = 4


def write_sorted(variants: DataFrame, path: str, rows_per_file: int = 2_000_000) -> None:
    """Variants dealt by range of place and sorted in each file."""
    dealt = variants.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def zones(spark: SparkSession, path: str) -> DataFrame:
    """file, n, first, last: the places that each file holds."""
    place = F.struct(*PLACE)
    table = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), place.alias("place"))
    return table.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.max("place").alias("last"))


def bits_of(value: Column) -> Column:
    """The bits that a value sets in its slice."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), value), F.lit(SLICE_BITS)) for i in range(HASHES)])


def slice_of(value: Column, n_slices: Column) -> Column:
    return F.pmod(F.xxhash64(value), n_slices)


def bloom_slices(spark: SparkSession, path: str, column: str) -> DataFrame:
    """file, slices, slice, bits: which values of a column each file may hold; slices grow in number with the values."""
    table = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), col(column).cast("string").alias("value"))
    values = table.filter("value IS NOT NULL").distinct()
    sizes = values.groupBy("file").agg((F.floor(F.count(F.lit(1)) / SLICE_VALUES) + 1).alias("slices"))
    dealt = values.join(F.broadcast(sizes), "file")  # a row per file
    marked = dealt.select("file", "slices", slice_of(F.col("value"), F.col("slices")).alias("slice"), F.explode(bits_of(F.col("value"))).alias("bit"))
    return marked.groupBy("file", "slices", "slice").agg(F.bitmap_construct_agg("bit").alias("bits"))


def has_bit(bits: Column, bit: Column) -> Column:
    """Whether a bitmap has a bit set."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


def write_index(spark: SparkSession, path: str, index: str, identifiers: Sequence[str] = ()) -> None:
    """Zone maps of a sorted table, and Bloom slices of the named columns, as tables below `index`."""
    zones(spark, path).write.mode("overwrite").parquet(f"{index}/zones")
    for name in identifiers:
        bloom_slices(spark, path, name).write.mode("overwrite").parquet(f"{index}/bloom_{name}")


def opened(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """The table cut to the named files; nothing else is opened."""
    names = sorted(row["file"] for row in files.select("file").collect())
    table = spark.read.parquet(path)
    return spark.read.schema(table.schema).parquet(*names) if names else table.limit(0)


def files_at(spark: SparkSession, index: str, chrom: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Files whose places reach into [first, last] of a chromosome, all of it by default."""
    zone = spark.read.parquet(f"{index}/zones")
    low = F.struct(F.lit(chrom).alias("CHROM"), F.lit(-(1 << 63) if first is None else first).cast("bigint").alias("POS"))
    high = F.struct(F.lit(chrom).alias("CHROM"), F.lit((1 << 63) - 1 if last is None else last).cast("bigint").alias("POS"))
    return zone.filter((F.col("last") >= low) & (F.col("first") <= high))


def indexed_lookup(spark: SparkSession, path: str, index: str, chrom: str, first: int, last: int | None = None) -> DataFrame:
    """Variants at a position, or from `first` to `last`; only files that hold such places are read."""
    last = first if last is None else last
    found = opened(spark, path, files_at(spark, index, chrom, first, last))
    return found.filter((F.col("CHROM") == chrom) & F.col("POS").between(first, last))


def indexed_slice(spark: SparkSession, path: str, index: str, chrom: str) -> DataFrame:
    """One chromosome."""
    return opened(spark, path, files_at(spark, index, chrom)).filter(F.col("CHROM") == chrom)


def indexed_identifier(spark: SparkSession, path: str, index: str, column: str, value: str) -> DataFrame:
    """Rows with an identifier; files whose Bloom bits rule it out are not read."""
    slices = spark.read.parquet(f"{index}/bloom_{column}")
    wanted = F.lit(value)
    mine = slices.filter(F.col("slice") == slice_of(wanted, F.col("slices")))
    may = F.forall(bits_of(wanted), lambda bit: has_bit(F.col("bits"), bit))
    return opened(spark, path, mine.filter(may)).filter(col(column) == value)
