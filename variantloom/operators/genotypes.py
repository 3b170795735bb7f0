"""Genotypes of a whole cohort, packed: two bits a sample, 32 samples a word, words only where somebody carries.

A code is 0 absent, 1 present without a known genotype, 2 HET, 3 HOM. Words are built by `bit_or` with map-side
combine, counted by `bit_count`, and taken apart into names only at export; no cell grows with the cohort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import labels as L
from variantloom.names import KEY, MISSING
from variantloom.operators.cohort import of_report, with_frequencies
from variantloom.session import small_side, written

PER_WORD = 32
# Words of a packed row: 2,048 samples.
WORDS = 64
LOW = 0x5555555555555555
LABELS = ["UNKWN", "HET", "HOM"]


def sample_dictionary(samples: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """SAMPLE, NUMBER: numbers for all names, those `known` kept. Written once, so numbers stay as they are."""
    names = samples.select("SAMPLE").filter("SAMPLE IS NOT NULL").distinct()
    if known is None:
        return written(names.select("SAMPLE", F.monotonically_increasing_id().alias("NUMBER")), "samples")
    start = known.select(F.coalesce(F.max("NUMBER") + 1, F.lit(0))).scalar()
    fresh = names.join(small_side(known.select("SAMPLE")), "SAMPLE", "left_anti")
    return written(known.unionByName(fresh.select("SAMPLE", (F.monotonically_increasing_id() + start).alias("NUMBER"))), "samples")


def code_of(zigosity: Column) -> Column:
    """Code of a genotype label that is not missing."""
    return (L.dosage(zigosity) + 1).cast("bigint")


def pack(calls: DataFrame, dictionary: DataFrame, unique: bool = False) -> DataFrame:
    """Key, BLOCK, WORDS (pairs of place and word) of calls; `unique` says that a sample has one row per variant.

    Several rows of a sample count as its highest dosage. Calls of samples that the dictionary lacks fail.
    """
    called = calls.filter(F.col("ZIGOSITY").isNotNull() & (F.col("ZIGOSITY") != MISSING))
    coded = called.select(*KEY, "SAMPLE", code_of(F.col("ZIGOSITY")).alias("_code"))
    numbered = coded.join(small_side(dictionary), "SAMPLE", "left").withColumn(
        "NUMBER", F.coalesce("NUMBER", F.raise_error(F.concat(F.lit("sample without a number: "), F.col("SAMPLE"))).cast("bigint"))
    )
    if not unique:
        numbered = numbered.groupBy(*KEY, "NUMBER").agg(F.max("_code").alias("_code"))
    seat = F.pmod("NUMBER", F.lit(PER_WORD)).cast("int") * 2
    word = F.call_function("shiftleft", F.col("_code"), seat)
    words = numbered.groupBy(*KEY, F.shiftright("NUMBER", 5).alias("_at")).agg(F.bit_or(word).alias("word"))
    return rows_of_words(words)


def rows_of_words(words: DataFrame) -> DataFrame:
    """Words (key, _at, word) gathered into rows of at most WORDS."""
    place = F.pmod("_at", F.lit(WORDS)).cast("int").alias("place")
    return words.groupBy(*KEY, F.shiftright("_at", 6).alias("BLOCK")).agg(F.sort_array(F.collect_list(F.struct(place, "word"))).alias("WORDS"))


def unpacked_words(packed: DataFrame) -> DataFrame:
    return packed.select(*KEY, "BLOCK", F.inline("WORDS")).select(*KEY, (F.shiftleft("BLOCK", 6) + F.col("place")).alias("_at"), "word")


def merge_packed(one: DataFrame, other: DataFrame) -> DataFrame:
    """Packed rows of distinct samples under one dictionary put together, without taking words apart."""
    both = unpacked_words(one).unionByName(unpacked_words(other))
    return rows_of_words(both.groupBy(*KEY, "_at").agg(F.bit_or("word").alias("word")))


def word_counts(word: Column) -> tuple[Column, Column]:
    """Carriers and alleles of a word."""
    low, high = word.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(word, 1).bitwiseAND(F.lit(LOW))
    hom = F.bit_count(low.bitwiseAND(high))
    return F.bit_count(low.bitwiseOR(high)), F.bit_count(high) + hom


def packed_stats(packed: DataFrame) -> DataFrame:
    """Key, N_CARRIERS, N_ALLELES by counting bits."""
    zero = F.lit(0).cast("bigint")

    def total(which: int) -> Column:
        return F.aggregate("WORDS", zero, lambda n, x: n + word_counts(x["word"])[which])

    return packed.groupBy(*KEY).agg(F.sum(total(0)).alias("N_CARRIERS"), F.sum(total(1)).alias("N_ALLELES"))


def packed_frequencies(packed: DataFrame, n_samples: Column | int) -> DataFrame:
    return with_frequencies(packed_stats(packed), n_samples)


def unpack(packed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """SAMPLE, key, ZIGOSITY: the long table back from packed rows."""
    words = unpacked_words(packed)
    seats = F.transform(
        F.sequence(F.lit(0), F.lit(PER_WORD - 1)),
        lambda i: F.struct(i.alias("seat"), F.call_function("shiftrightunsigned", F.col("word"), i * 2).bitwiseAND(F.lit(3)).cast("int").alias("code")),
    )
    cells = words.select(*KEY, "_at", F.inline(F.filter(seats, lambda x: x["code"] > 0)))
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.col("code"))
    numbered = cells.select(*KEY, (F.shiftleft("_at", 5) + F.col("seat")).alias("NUMBER"), label.alias("ZIGOSITY"))
    return numbered.join(small_side(dictionary), "NUMBER").select("SAMPLE", *KEY, "ZIGOSITY")


def carriers_of(report: DataFrame, packed: DataFrame) -> DataFrame:
    """Packed rows of the report's variants, and N_CARRIERS over all samples: a variant of every sample is a few rows."""
    found = of_report(packed, report).join(report.select(*KEY).distinct(), KEY, "left_semi")
    return found.join(packed_stats(found).select(*KEY, "N_CARRIERS"), KEY)


def carrier_names(report: DataFrame, packed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Key, SAMPLE, N_CARRIERS: a row for each carrier of a report's variants, for export."""
    found = written(carriers_of(report, packed), "carriers")
    counts = found.select(*KEY, "N_CARRIERS").distinct()
    return unpack(found, dictionary).drop("ZIGOSITY").join(counts, KEY)
