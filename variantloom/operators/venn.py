"""Comparing samples: exact Venn membership and one merged row per variant.

All samples are united and grouped by the variant key once, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions.labels import col
from variantloom.names import KEY, SINGLE_SAMPLE_COLUMNS, SORT_KEY, VARIANT_LEVEL_MARKS
from variantloom.session import written


def regions(names: Sequence[str]) -> list[tuple[str, ...]]:
    """All non-empty sample combinations; each new sample adds its own and the joint regions."""
    out: list[tuple[str, ...]] = []
    for name in names:
        out += [(name,)] + [(*region, name) for region in out]
    return out


def labelled(presence: Mapping[str, Column]) -> list[Column]:
    """Columns `samples` (array) and `VENN` (":"-joined) from one presence flag per sample."""
    members = F.array_compact(
        F.array(*[F.when(flag, F.lit(name)) for name, flag in presence.items()])
    )
    return [members.alias("samples"), F.array_join(members, ":").alias("VENN")]


def membership(calls: DataFrame, names: Sequence[str], sample: str = "SAMPLE") -> DataFrame:
    """Variant key, samples, VENN for the named samples of a long table.

    One hash aggregate with map-side combine; rows per key and sample may repeat.
    """
    wanted = calls.filter(col(sample).isin(list(names)))
    flags = [F.max(F.when(col(sample) == n, 1).otherwise(0)).alias(f"_in{i}") for i, n in enumerate(names)]
    grouped = wanted.groupBy(*KEY).agg(*flags)
    presence = {n: F.col(f"_in{i}") == 1 for i, n in enumerate(names)}
    return grouped.select(*KEY, *labelled(presence))


def gather(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per variant with one struct per sample (`_s0`, `_s1`, ...), NULL when absent."""
    shapes = layout(tables)

    def placed(name: str, df: DataFrame) -> DataFrame:
        own = [
            F.struct(*[col(c) for c in fields]) if other == name else F.lit(None).cast(struct_type)
            for other, fields, struct_type in shapes
        ]
        return df.select(*KEY, *[value.alias(f"_s{i}") for i, value in enumerate(own)])

    united = reduce(lambda a, b: a.unionByName(b), [placed(n, df) for n, df in tables.items()])
    return one_row_per_variant(united, list(tables))


def gather_long(variants: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same from one long table, read once."""
    fields = F.struct(*[col(c) for c in compared_columns(variants)])
    own = [F.when(F.col("SAMPLE") == name, fields).alias(f"_s{i}") for i, name in enumerate(names)]
    return one_row_per_variant(variants.filter(F.col("SAMPLE").isin(list(names))).select(*KEY, *own), names)


def one_row_per_variant(placed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Group by variant, with map-side combine.

    Variants must be unique within a sample; a repeated one fails the job instead of
    losing rows.
    """
    parts: list[Column] = []
    for i in range(len(names)):
        parts += [F.max(f"_s{i}").alias(f"_s{i}"), F.count(f"_s{i}").alias(f"_n{i}")]
    grouped = placed.groupBy(*SORT_KEY).agg(*parts)
    checked = [
        F.when(
            F.col(f"_n{i}") > 1,
            F.raise_error(F.lit(f"variant repeats within sample {name}: keep one row per variant first")),
        )
        .otherwise(F.col(f"_s{i}"))
        .alias(f"_s{i}")
        for i, name in enumerate(names)
    ]
    return grouped.select(*KEY, *checked)


def compared_columns(df: DataFrame) -> list[str]:
    skipped = {*KEY, *SINGLE_SAMPLE_COLUMNS, "SAMPLE", "VENN", "samples"}
    return [c for c in df.columns if c not in skipped]


def layout(tables: Mapping[str, DataFrame]) -> list[tuple[str, list[str], str]]:
    """Per sample: its name, compared columns, and their struct type."""
    out = []
    for name, df in tables.items():
        fields = compared_columns(df)
        kinds = dict(df.dtypes)
        inner = ", ".join(f"`{c}`: {kinds[c]}" for c in fields)
        out.append((name, fields, f"struct<{inner}>" if fields else "struct<_present: boolean>"))
    return out


def owners(tables: Mapping[str, DataFrame]) -> dict[str, list[int]]:
    """Column -> positions of the samples that have it, in first-seen order."""
    found: dict[str, list[int]] = {}
    for i, df in enumerate(tables.values()):
        for c in compared_columns(df):
            found.setdefault(c, []).append(i)
    return found


def field(i: int, name: str) -> Column:
    return F.col(f"_s{i}").getField(name)


def is_variant_level(name: str) -> bool:
    return any(mark in name for mark in VARIANT_LEVEL_MARKS)


def first_present(name: str, places: Sequence[int]) -> Column:
    """A column's value in the first sample that has the variant."""
    return reduce(lambda rest, i: F.when(F.col(f"_s{i}").isNotNull(), field(i, name)).otherwise(rest), reversed(places), F.lit(None))


def differing_columns(gathered: DataFrame, shared: Mapping[str, list[int]]) -> set[str]:
    """Columns that differ between samples on any shared variant (runs one aggregate)."""
    if not shared:
        return set()
    # Each sample is compared with the first one present, so the expressions grow with the samples only.
    first = {f"_first{n}": first_present(name, places) for n, (name, places) in enumerate(shared.items())}
    checks = []
    for n, (name, places) in enumerate(shared.items()):
        others = [F.col(f"_s{i}").isNotNull() & ~field(i, name).eqNullSafe(F.col(f"_first{n}")) for i in places[1:]]
        differs = reduce(lambda x, y: x | y, others)
        checks.append(F.max(F.when(differs, 1).otherwise(0)).alias(f"d{n}"))
    gathered = gathered.withColumns(first)
    row = gathered.agg(*checks).first()
    return {name for n, name in enumerate(shared) if row[f"d{n}"]}


def compare_samples(
    tables: Mapping[str, DataFrame], separate: Sequence[str] | None = None
) -> DataFrame:
    """Full outer comparison of samples: key, VENN, samples and the reconciled columns.

    Quality columns of single samples are left out. A column that several samples have
    is kept once when it describes the variant, or when it is equal on every shared
    variant; otherwise it appears as NAME_<sample>. Equality is a property of the data,
    so it costs one aggregate over the merged table, which is written to shared storage
    first. Pass `separate` (names to keep per sample) to stay lazy.
    """
    return reconciled(gather(tables), list(tables), owners(tables), separate)


def compare_long(
    variants: DataFrame, names: Sequence[str], separate: Sequence[str] | None = None
) -> DataFrame:
    """`compare_samples` for the named samples of one long table, which is read once."""
    found = {c: list(range(len(names))) for c in compared_columns(variants)}
    return reconciled(gather_long(variants, names), names, found, separate)


def reconciled(
    gathered: DataFrame,
    names: Sequence[str],
    found: Mapping[str, list[int]],
    separate: Sequence[str] | None,
) -> DataFrame:
    undecided = {
        c: places for c, places in found.items() if len(places) > 1 and not is_variant_level(c)
    }
    if separate is None:
        gathered = written(gathered, "compare")
        per_sample = differing_columns(gathered, undecided)
    else:
        per_sample = set(separate) & set(undecided)
    out: list[Column] = []
    for c, places in found.items():
        if c in per_sample:
            out += [field(i, c).alias(f"{c}_{names[i]}") for i in places]
        else:
            out.append(first_present(c, places).alias(c))
    presence = {n: F.col(f"_s{i}").isNotNull() for i, n in enumerate(names)}
    return gathered.select(*KEY, *labelled(presence), *out)


def place_letter(i: int) -> str:
    """A ... Z, then AA, AB, ... for the sample at place i."""
    head, last = divmod(i, 26)
    return (place_letter(head - 1) if head else "") + chr(ord("A") + last)


def venn_place(df: DataFrame, place: str | None, names: Sequence[str]) -> DataFrame:
    """Rows of exactly one region; places are letters in sample order ("A", "A:C", ...).

    None or "ALL" keeps every region.
    """
    if place is None or place == "ALL":
        return df
    letters = [place_letter(i) for i in range(len(names))]
    at = [letters.index(letter) if letter in letters else -1 for letter in place.split(":")]
    if -1 in at or at != sorted(set(at)):
        raise ValueError(f"place must be letters from {letters[0]} to {letters[-1]}, each once, in order, joined by ':'")
    wanted = [names[i] for i in at]
    return df.filter(F.col("samples") == F.array(*[F.lit(n) for n in wanted]))


def venn_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per region, including empty regions."""
    places = [(i, ":".join(region)) for i, region in enumerate(regions(names))]
    listing = df.sparkSession.createDataFrame(places, "region_order int, VENN string")
    counts = df.groupBy("VENN").agg(F.count(F.lit(1)).alias("variants"))
    return listing.join(counts, "VENN", "left").select(
        "region_order", "VENN", F.coalesce("variants", F.lit(0)).alias("variants")
    )


def presence_masks(calls: DataFrame, names: Sequence[str], sample: str = "SAMPLE") -> DataFrame:
    """Variant key and MASK of the named samples (63 at most), bit i for the i-th; one aggregate, map-side combine."""
    if len(names) > 63:
        raise ValueError("a mask holds 63 samples")
    bits = F.create_map(*[part for i, n in enumerate(names) for part in (F.lit(n), F.lit(1 << i).cast("bigint"))])
    wanted = calls.select(*KEY, F.try_element_at(bits, col(sample)).alias("_bit")).filter("_bit IS NOT NULL")
    return wanted.groupBy(*KEY).agg(F.bit_or("_bit").alias("MASK"))


def region_of(mask: Column, names: Sequence[str]) -> Column:
    """":"-joined names of a mask's samples, in their order."""
    told = [F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(n)) for i, n in enumerate(names)]
    return F.concat_ws(":", *told)


def mask_counts(masks: DataFrame) -> DataFrame:
    """MASK, variants: how many variants are in exactly these samples; only regions that occur."""
    return masks.groupBy("MASK").agg(F.count(F.lit(1)).alias("variants"))


def sub_masks(mask: Column, n: int, size: int) -> Column:
    """All non-empty sub-masks of at most `size` bits: each round adds a bit above a mask's highest."""
    bits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i)), lambda b: b.bitwiseAND(mask) != 0)
    found = grown = bits
    for _ in range(size - 1):
        grown = F.flatten(F.transform(grown, lambda m: F.transform(F.filter(bits, lambda b: b > m), lambda b: m.bitwiseOR(b))))
        found = F.concat(found, grown)
    return found


def at_least_counts(counts: DataFrame, n: int, size: int = 2) -> DataFrame:
    """MASK, variants: how many variants are in at least these samples, for regions of up to `size` of the n samples.

    Sums over supersets: every occurring mask, with its count, adds to its sub-masks. Their number
    goes with n to the power of `size`, not with the variants.
    """
    spread = counts.select(F.explode(sub_masks(F.col("MASK"), n, size)).alias("MASK"), "variants")
    return spread.groupBy("MASK").agg(F.sum("variants").alias("variants"))


def shared_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of `a` whose variant is also in `b`."""
    return a.join(b.select(*KEY), SORT_KEY, "left_semi")


def own_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of `a` whose variant is not in `b`."""
    return a.join(b.select(*KEY), SORT_KEY, "left_anti")
