"""Counts, profiles and differences of variant tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantloom.functions.labels import col, quoted
from variantloom.names import KEY
from variantloom.session import written


def general_stats(df: DataFrame) -> DataFrame | None:
    """Variants per (CHROM, VARTYPE, IMPACT, EFFECT), by ZIGOSITY too for a single sample.

    None when a column is missing.
    """
    by = ["CHROM", "VARTYPE", "IMPACT", "EFFECT"]
    if "VENN" not in df.columns:
        by.insert(1, "ZIGOSITY")
    if not set(by) <= set(df.columns):
        return None
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def stats_by_chrom(stats: DataFrame) -> DataFrame:
    """Groups and variants of `general_stats` per chromosome."""
    return stats.groupBy("CHROM").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("count").alias("variants")
    )


def annotation_multiplicity(df: DataFrame) -> DataFrame:
    """One row: number of variants, and how many have one or several rows."""
    rows = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(
        F.count(F.lit(1)).alias("variants"),
        F.count_if(F.col("n") == 1).alias("single"),
        F.count_if(F.col("n") > 1).alias("multiple"),
    )


def dataset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows over the common columns with their count on each side and a `_merge` label.

    Missing values are equal to each other; one aggregate with map-side combine.
    """
    common = [c for c in left.columns if c in right.columns]
    sides = left.select(*[col(c) for c in common], F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*[col(c) for c in common], F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    grouped = sides.groupBy(*[col(c) for c in common]).agg(
        F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right")
    )
    label = (
        F.when(F.col("n_right") == 0, F.lit("left_only"))
        .when(F.col("n_left") == 0, F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return grouped.withColumn("_merge", label)


def diff_counts(diff: DataFrame) -> DataFrame:
    """Joined rows per `_merge` label: a row held m and n times on both sides counts m * n."""
    weight = F.greatest("n_left", F.lit(1)) * F.greatest("n_right", F.lit(1))
    return diff.groupBy("_merge").agg(F.sum(weight).alias("rows"))


def filled_counts(df: DataFrame) -> DataFrame:
    """One row per column: upper-case name and number of non-missing cells (one pass)."""
    counts = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = [
        F.struct(F.lit(c.upper()).alias("name"), F.col(f"c{i}").alias("filled"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of either dataset, ignoring case, with their non-missing cells on each side."""
    a = filled_counts(left).withColumnRenamed("filled", "left_filled")
    b = filled_counts(right).withColumnRenamed("filled", "right_filled")
    label = (
        F.when(F.col("right_filled").isNull(), F.lit("left_only"))
        .when(F.col("left_filled").isNull(), F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return a.join(b, "name", "full_outer").select("name", label.alias("side"), "left_filled", "right_filled")


RANGE_BLOCK = 16
RANGES = RANGE_BLOCK * RANGE_BLOCK
LEVELS = 2  # the ranges that hold a wanted rank are cut up once more: 65,536 parts of a column


def cuts_upto(value: Column) -> Column:
    """How many of the sorted `cuts` are at most `value`: look among every 16th, then within 16."""
    blocks = F.size(F.filter("block_cuts", lambda cut: cut <= value)) * RANGE_BLOCK
    inside = F.slice("cuts", blocks + 1, RANGE_BLOCK - 1)
    # Never NULL; saying so spares a null check that would compute it twice.
    return F.coalesce(blocks + F.size(F.filter(inside, lambda cut: cut <= value)), F.lit(0))


def wanted_ranks(probabilities: Sequence[float]) -> list[tuple[Column, Column]]:
    """For each probability the two ranks, from 0, that its quantile lies between, from `size`."""
    places = [(F.col("size") - 1) * F.lit(float(p)) for p in probabilities]
    return [(F.floor(place), F.ceil(place)) for place in places]


def narrowed(rows: DataFrame, by: list[str], part: str, probabilities: Sequence[float]) -> DataFrame:
    """The rows (name, value, n, before) of those ranges that hold a wanted rank; `part` names the range.

    `before` counts the cells ahead of a range. The approximate cut points only balance the work.
    """
    steps = [i / RANGES for i in range(1, RANGES)]
    size = [] if "size" in rows.columns else [F.sum("n").alias("size")]
    cuts = rows.groupBy(*by).agg(F.percentile_approx("value", steps, 8 * RANGES).alias("cuts"), *size)
    block_ends = F.transform(
        F.sequence(F.lit(1), F.lit(RANGE_BLOCK - 1)), lambda k: F.element_at("cuts", k * RANGE_BLOCK)
    )
    # One row per column of the table, later one per wanted range of each.
    cuts = F.broadcast(cuts.withColumn("block_cuts", block_ends))
    ranged = rows.join(cuts, by).select(*by, "value", "n", "before", "size", cuts_upto(F.col("value")).alias(part))
    totals = ranged.groupBy(*by, part).agg(F.sum("n").alias("n"), F.max("before").alias("before"), F.max("size").alias("size"))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ends = totals.select(*by, part, "n", "size", start.alias("before"))
    held = [(F.col("before") <= r) & (r < F.col("before") + F.col("n")) for pair in wanted_ranks(probabilities) for r in pair]
    # At most two rows per probability and column of the table.
    kept = F.broadcast(ends.filter(reduce(lambda x, y: x | y, held)).select(*by, part, "before"))
    return ranged.drop("before").join(kept, [*by, part])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles of whole columns, without gathering a column in one task.

    Values are counted first (hot values shrink map-side) and spread over ranges between
    approximate cut points. Only ranges that hold a wanted rank go on: they are cut up again,
    and what is left is ranked by a running count plus the total of all ranges before.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("name"), col(c).cast("double").alias("value")) for c in columns]
    )
    rows = (
        df.select(F.inline(cells))
        .filter("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        # Always true; it makes every use of the counts need them, so all share one shuffle.
        .filter("n > 0")
        .withColumn("before", F.lit(0).cast("bigint"))
    )
    by = ["name"]
    for level in range(LEVELS):
        rows = narrowed(rows, by, f"range{level}", probabilities)
        by = [*by, f"range{level}"]
    within = Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = rows.withColumn("upto", F.col("before") + F.sum("n").over(within))

    def holding(rank: Column) -> Column:
        inside = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(inside, F.col("value")))

    parts = []
    for i, (p, (low, high)) in enumerate(zip(probabilities, wanted_ranks(probabilities))):
        place = (F.col("size") - 1) * F.lit(float(p))
        parts += [
            holding(low).alias(f"lo{i}"),
            holding(high).alias(f"hi{i}"),
            F.max(place - F.floor(place)).alias(f"f{i}"),
        ]
    found = ranks.groupBy("name").agg(*parts)
    return found.select(
        "name",
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"f{i}")).alias(
                f"p{round(p * 100)}"
            )
            for i, p in enumerate(probabilities)
        ],
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-missing cells; mean, std, min, quartiles, max of numbers."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    parts: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        parts.append(F.count(col(c)).alias(f"filled{i}"))
        if c in numeric:
            value = col(c).cast("double")
            parts += [
                F.avg(value).alias(f"mean{i}"),
                F.stddev_samp(value).alias(f"std{i}"),
                F.min(value).alias(f"min{i}"),
                F.max(value).alias(f"max{i}"),
            ]
    totals = df.agg(*parts)
    kinds = dict(df.dtypes)

    def number(prefix: str, i: int, c: str) -> Column:
        return F.col(f"{prefix}{i}") if c in numeric else F.lit(None).cast("double")

    rows = [
        F.struct(
            F.lit(c).alias("name"),
            F.lit(kinds[c]).alias("type"),
            F.col("rows"),
            F.col(f"filled{i}").alias("filled"),
            number("mean", i, c).alias("mean"),
            number("std", i, c).alias("std"),
            number("min", i, c).alias("min"),
            number("max", i, c).alias("max"),
        )
        for i, c in enumerate(df.columns)
    ]
    table = totals.select(F.inline(F.array(*rows)))
    if not numeric:
        return table
    return table.join(exact_quantiles(df, numeric, [0.25, 0.5, 0.75]), "name", "left")


def list_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of a column, sorted: samples, genes of panels, chromosomes."""
    return df.select(col(name)).distinct().orderBy(col(name))


DIGIT = 16


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """`by` and _q, the exact quantiles (linear interpolation) of whole numbers for each group.

    Equal values are counted first. Ranks are then looked for digit by digit, 16 bits at a time, among the counts of a
    group's digits: no buffer or window holds more than 65,536 rows, however many values a group has. NULLs do not count.
    """
    by = list(by)
    counts = df.filter(col(value).isNotNull()).groupBy(*[col(c) for c in by], col(value).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts = written(counts, "value-counts")
    largest = counts.select(F.max(F.abs("_v"))).first()[0] or 0
    levels = max(1, -(-(int(largest).bit_length() + 1) // DIGIT))
    size = F.col("_size") - 1
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(f(size * F.lit(float(p)))) for p in probabilities for f in (F.floor, F.ceil)])))
    sizes = counts.groupBy(*[col(c) for c in by]).agg(F.sum("_n").alias("_size"))
    keys = [quoted(c) for c in by]
    wanted = sizes.select(*keys, "_size", F.lit(None).cast("bigint").alias("_prefix"), F.explode(ranks).alias("_rank")).withColumn("_left", F.col("_rank"))
    for level in reversed(range(levels)):
        digit = F.shiftright("_v", DIGIT * level).alias("_digit")
        above = (F.lit(None).cast("bigint") if level == levels - 1 else F.shiftright("_v", DIGIT * (level + 1))).alias("_prefix")
        asked = wanted.groupBy(*keys, "_prefix").agg(F.collect_set(F.struct("_size", "_rank", "_left")).alias("_asked"))
        held = counts.select(*keys, above, digit, "_n").groupBy(*keys, "_prefix", "_digit").agg(F.sum("_n").alias("_n"))
        same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"h.{c}")) for c in [*keys, "_prefix"]])
        open_rows = held.alias("h").join(asked.alias("a"), same).select(*[f"h.{c}" for c in keys], "h._prefix", "_digit", "_n", "_asked")
        end = F.sum("_n").over(Window.partitionBy(*keys, "_prefix").orderBy("_digit"))
        placed = open_rows.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
        mine = F.filter("_asked", lambda x: (x["_left"] >= F.col("_start")) & (x["_left"] < F.col("_end")))
        found = placed.select(*keys, "_digit", "_start", F.inline(mine))
        wanted = written(
            found.select(*keys, "_size", F.col("_digit").alias("_prefix"), "_rank", (F.col("_left") - F.col("_start")).alias("_left")), "ranks"
        )
    told = wanted.groupBy(*keys, "_size").agg(F.map_from_entries(F.collect_list(F.struct("_rank", F.col("_prefix").cast("double")))).alias("_at"))
    places = [(size * F.lit(float(p)), F.floor(size * F.lit(float(p)))) for p in probabilities]
    quantiles = [
        F.element_at("_at", low) + (F.element_at("_at", F.ceil(place)) - F.element_at("_at", low)) * (place - low) for place, low in places
    ]
    return told.select(*keys, F.array(*quantiles).alias("_q"))
