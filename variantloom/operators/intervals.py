"""Half-open genome intervals: depth runs, overlap joins, depth summaries.

The genome is cut into bins, so no step gathers a whole chromosome in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.functions.labels import col
from variantloom.operators.stats import grouped_quantiles
from variantloom.session import BROADCAST_BYTES, BROADCAST_ROWS, row_bytes

DEPTH_BIN = 1 << 17
# Overlap joins: width of the lowest level's bins, how much wider each level is than the one below, and how many levels there are.
JOIN_BIN = 1 << 10
LEVEL_BITS = 4
LEVELS = 8


def bin_of(position: Column, width: int) -> Column:
    return F.call_function("div", position, F.lit(width))


def depth_runs(
    reads: DataFrame,
    lengths: DataFrame | None = None,
    by: Sequence[str] = ("CHROM",),
    bin_width: int = DEPTH_BIN,
) -> DataFrame:
    """Runs of equal depth (including zero) over aligned intervals START, END.

    Depth changes are summed per position first, so a pile-up shrinks before the
    shuffle. Each bin then holds at most `bin_width` positions; the depth carried into
    a bin comes from running totals over bins. With `lengths` (the `by` columns and
    LENGTH) the zero runs before the first and after the last read are included, and
    chromosomes without reads; reads must lie within their chromosome.
    """
    by = list(by)
    steps = F.array(
        F.struct(F.col("START").cast("bigint").alias("POS"), F.lit(1).alias("step")),
        F.struct(F.col("END").cast("bigint").alias("POS"), F.lit(-1).alias("step")),
    )
    changes = reads.filter("START < END").select(*by, F.inline(steps)).withColumn("edge", F.lit(0))
    if lengths is not None:
        ends = lengths.select(
            *by, F.explode(F.array(F.lit(0).cast("bigint"), F.col("LENGTH").cast("bigint"))).alias("POS")
        )
        changes = changes.unionByName(ends.withColumns({"step": F.lit(0), "edge": F.lit(1)}))
    points = (
        changes.groupBy(*by, "POS")
        .agg(F.sum("step").alias("step"), F.max("edge").alias("edge"))
        .filter("step <> 0 OR edge = 1")
        .withColumn("bin", bin_of(F.col("POS"), bin_width))
        # The join below implies this for one side; said for both, they share one shuffle.
        .filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, "bin"]]))
    )
    order = Window.partitionBy(*by).orderBy("bin")
    bins = (
        points.groupBy(*by, "bin")
        .agg(F.sum("step").alias("total"), F.min("POS").alias("first"))
        .select(
            *by,
            "bin",
            F.coalesce(
                F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("carried"),
            F.lead("first").over(order).alias("following"),
        )
    )
    inside = Window.partitionBy(*by, "bin").orderBy("POS")
    runs = points.join(bins, [*by, "bin"]).select(
        *by,
        F.col("POS").alias("START"),
        F.coalesce(F.lead("POS").over(inside), F.col("following")).alias("END"),
        (F.col("carried") + F.sum("step").over(inside)).alias("DEPTH"),
    )
    return runs.filter("END IS NOT NULL")


def level_of(width: int) -> Column:
    """The level whose bins are the smallest that are at least as wide as the interval."""
    length = F.col("END") - F.col("START")
    return reduce(lambda a, b: a + b, [(length > F.lit(width << LEVEL_BITS * i)).cast("int") for i in range(LEVELS - 1)])


def bin_keys(level: Column | int, width: int, role: int) -> Column:
    """Keys of the bins that the interval touches at a level; at its own or a higher one these are at most two."""
    level = F.lit(level) if isinstance(level, int) else level
    wide = F.call_function("shiftleft", F.lit(width).cast("bigint"), level * LEVEL_BITS)
    first, last = F.call_function("div", F.col("START"), wide), F.call_function("div", F.col("END") - 1, wide)

    def key(b: Column) -> Column:
        return (b * LEVELS + level) * 2 + role

    two = F.when(first == last, F.array(key(first))).when(first + 1 == last, F.array(key(first), key(last)))
    return two.otherwise(F.transform(F.sequence(first, last), key))  # longer than the widest bins


def when_level(condition: Column, keys: Column) -> Column:
    return F.when(condition, keys).otherwise(F.array().cast("array<bigint>"))


def looking_keys(levels: Sequence[int], width: int) -> Column:
    """Keys under which an interval looks up intervals of the given levels.

    Role 0: bins of each level that is not below its own. Role 1: its own bins, for all that lie below.
    """
    own = F.col("_level")
    parts = [when_level(own <= i, bin_keys(i, width, 0)) for i in levels]
    parts += [when_level(own > min(levels), bin_keys(own, width, 1))] if levels else []
    return F.concat(*parts) if parts else F.array().cast("array<bigint>")


def lying_keys(width: int) -> Column:
    """Keys under which an interval is found: its own bins (role 0), and those above them (role 1)."""
    own = F.col("_level")
    above = [when_level(own < i, bin_keys(i, width, 1)) for i in range(1, LEVELS)]
    return F.concat(bin_keys(own, width, 0), *above)


def with_keys(df: DataFrame, width: int, keys: Column) -> DataFrame:
    """Non-empty intervals with _level and _keys."""
    return df.filter("START < END").withColumn("_level", level_of(width)).withColumn("_keys", keys)


def overlaps(
    a: DataFrame,
    b: DataFrame,
    b_columns: Sequence[str] = (),
    by: Sequence[str] = ("CHROM",),
    bin_width: int = JOIN_BIN,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of `a` clipped to each overlapping interval of `b`, plus columns of `b`.

    Bins are nested: those of a level are 2**LEVEL_BITS times as wide as those below. An interval belongs to the level
    whose bins are just as wide as it is long, so it touches one or two of them however long it is, and what
    shares its bin is not much shorter. Two intervals meet at the level of the longer one, in the bin
    where their overlap starts: an equi-join on (chromosome, bin), and each pair comes out once. `b`
    is read once for its size and its levels, then broadcast if small (no shuffle of `a`); else
    AQE splits crowded bins of the shuffle join.
    """
    by = list(by)
    narrow = b.select(
        *by, F.col("START").cast("bigint").alias("START"), F.col("END").cast("bigint").alias("END"), *[col(c).alias(f"_b_{c}") for c in b_columns]
    )
    right = with_keys(narrow, bin_width, lying_keys(bin_width))
    found = right.agg(
        F.sum(F.size("_keys")).alias("rows"), F.sum(row_bytes(narrow) * F.size("_keys")).alias("bytes"), F.collect_set("_level").alias("levels")
    ).first()
    small = (found["rows"] or 0) <= max_broadcast_rows and (found["bytes"] or 0) <= BROADCAST_BYTES
    right = right.select(
        *by, F.explode("_keys").alias("_key"), F.col("START").alias("_bs"), F.col("END").alias("_be"), *[col(f"_b_{c}") for c in b_columns]
    )
    right = F.broadcast(right) if small and max_broadcast_rows > 0 else right.hint("merge")
    left = with_keys(a, bin_width, looking_keys(sorted(found["levels"]), bin_width)).select(*[col(c) for c in a.columns], F.explode("_keys").alias("_key"))
    start = F.greatest("START", "_bs")
    # A key is (bin * LEVELS + level) * 2 + role.
    level = F.pmod(F.shiftright("_key", 1), F.lit(LEVELS)).cast("int")
    wide = F.element_at(F.array(*[F.lit(bin_width << LEVEL_BITS * i).cast("bigint") for i in range(LEVELS)]), level + 1)
    pairs = left.join(right, [*by, "_key"]).filter(
        (F.col("START") < F.col("_be"))
        & (F.col("_bs") < F.col("END"))
        & (F.call_function("div", start, wide) * LEVELS + level == F.shiftright("_key", 1))
    )
    out = []
    for c in a.columns:
        if c == "START":
            out.append(start.alias("START"))
        elif c == "END":
            out.append(F.least("END", "_be").alias("END"))
        else:
            out.append(col(c))
    return pairs.select(*out, *[col(f"_b_{c}").alias(c) for c in b_columns])


def interval_intersect(a: DataFrame, b: DataFrame, **options) -> DataFrame:
    """`a` clipped to its overlaps with `b`, one row per overlapping pair."""
    return overlaps(a, b, (), **options)


def annotate_genes(runs: DataFrame, genes: DataFrame, name: str = "GENE_EXON", **options) -> DataFrame:
    """Depth runs clipped to gene intervals, with the interval's name as EXON."""
    return overlaps(runs, genes, [name], **options).withColumnRenamed(name, "EXON")


def with_gene(coverage: DataFrame) -> DataFrame:
    return coverage.withColumn("GENE", F.substring_index("EXON", "_", 1))


def depth_summary(coverage: DataFrame, level: str = "GENE", by: Sequence[str] = (), spread: bool = False) -> DataFrame:
    """Mean, std, min, quartiles, max of DEPTH over the runs of each (level, CHROM).

    Exact quartiles keep one counter per distinct depth of a group, merged map-side; with `spread`
    they are found over ranges of depths, for groups whose counters would not fit a task.
    """
    if level == "GENE" and "GENE" not in coverage.columns:
        coverage = with_gene(coverage)
    quartiles = F.percentile("DEPTH", [0.25, 0.5, 0.75])
    grouped = coverage.groupBy(*by, level, "CHROM").agg(
        F.avg("DEPTH").alias("mean"),
        F.stddev_samp("DEPTH").alias("std"),
        F.min("DEPTH").alias("min"),
        quartiles.alias("_q"),
        F.max("DEPTH").alias("max"),
    )
    if spread:
        groups = [*by, level, "CHROM"]
        apart = grouped_quantiles(coverage, groups, "DEPTH", [0.25, 0.5, 0.75])
        same = reduce(lambda a, b: a & b, [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in groups])
        grouped = grouped.drop("_q").alias("l").join(apart.alias("r"), same, "left").select("l.*", "r._q")
    q = F.col("_q")
    return grouped.select(
        *by, level, "CHROM", "mean", "std", "min",
        q[0].alias("25%"), q[1].alias("50%"), q[2].alias("75%"), "max",
    )
