"""Source mixing by entropy balancing, in built-in functions only.

Rates are as close as can be (in relative entropy, weighted by tokens) to the base rates while each
source's expected tokens meet its target. The solution tilts the base rates exponentially,
rate = min(cap, base * exp(tilt of the source)); the tilts maximise a concave dual, which Newton
steps solve: each step is one aggregate over cells of equal source and base rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.llm.numbering import numbered, same
from variantloom.session import written

STEPS = 60
TOLERANCE = 1e-12
LONGEST_STEP = 1.0
RATE_DIGITS = 9


def source_sizes(docs: DataFrame) -> DataFrame:
    """source, source_size from rows with source and size; NULL counts as one source."""
    return docs.groupBy("source").agg(F.sum("size").alias("source_size"))


def shared_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, source_size, target: all tokens shared by weight, no source above `cap` times its own.

    Sources in code point order, NULL last, take the weights in turn. What a source cannot take is
    shared among the others by weight until none is above its bound: sources are capped in the order
    of bound per weight as long as the level of the rest lies above that ratio.
    """
    # One row per source: these windows hold the source list, never documents.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(turns, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    rows = sources.withColumn("_weight", weight).withColumn("_bound", F.col("source_size") * F.lit(float(cap)))
    rows = rows.withColumn("_ratio", F.col("_bound") / F.col("_weight"))
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    capped_before = F.sum("_bound").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    weight_left = F.sum("_weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(capped_before, F.lit(0.0))
    rows = rows.withColumn("_level", left / weight_left)
    rows = rows.withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    # The first source that stays open sets the level of all that do.
    level = F.min_by("_level", F.when(~F.col("_capped"), F.struct("_ratio", F.coalesce("source", F.lit(""))))).over(everything)
    target = F.when(F.col("_capped"), F.col("_bound")).otherwise(F.col("_weight") * level)
    return rows.select("source", "source_size", target.alias("target"))


def rate(cap: float) -> Column:
    """The tilted rate of rows with base, tilt, target and bound (what the source gives at `cap`)."""
    tilted = F.least(F.lit(float(cap)), F.col("base") * F.exp("tilt"))
    edge = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= F.col("bound"), F.lit(float(cap)))
    return F.round(F.coalesce(edge, tilted), RATE_DIGITS)


def balanced(cells: DataFrame, targets: DataFrame, cap: float = 3.0) -> DataFrame:
    """source, source_size, target, bound, tilt: Newton's method on the dual, for all sources at once.

    `cells` has source, base, tokens. The steps start at the tilt that fits if nothing is capped and
    end when every source meets its target to a relative TOLERANCE (or lies at 0 or at its bound).
    """
    tokens = cells.groupBy("source").agg(
        (F.sum("tokens") * F.lit(float(cap))).alias("bound"),
        F.sum(F.col("tokens") * F.col("base")).alias("_base"),
    )
    state = targets.alias("l").join(tokens.alias("r"), same(["source"])).select(
        "l.source", "source_size", "target", "bound",
        F.when((F.col("target") > 0) & (F.col("_base") > 0), F.log(F.col("target") / F.col("_base"))).otherwise(0.0).alias("tilt"),
    )
    state = written(state, "tilts")
    for _ in range(STEPS):
        given = F.col("tokens") * F.least(F.lit(float(cap)), F.col("base") * F.exp("tilt"))
        free = F.when(F.col("base") * F.exp("tilt") < F.lit(float(cap)), given).otherwise(0.0)
        sums = (
            cells.alias("l").join(state.alias("r"), same(["source"]))
            .groupBy("r.source", "source_size", "target", "bound", "tilt")
            .agg(F.sum(given).alias("_given"), F.sum(free).alias("_slope"))
        )
        gap = F.col("target") - F.col("_given")
        open_ = (F.col("target") > 0) & (F.col("target") < F.col("bound"))
        step = F.when(F.col("_slope") > 0, gap / F.col("_slope")).otherwise(F.signum(gap) * LONGEST_STEP)
        step = F.greatest(F.lit(-LONGEST_STEP), F.least(F.lit(LONGEST_STEP), step))
        miss = F.when(open_, F.abs(gap) / F.col("target")).otherwise(0.0)
        moved = F.when(miss > TOLERANCE, F.col("tilt") + step).otherwise(F.col("tilt"))
        state = written(sums.select("source", "source_size", "target", "bound", moved.alias("tilt"), miss.alias("miss")), "tilts")
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("source", "source_size", "target", "bound", "tilt")


def mixed(
    rows: DataFrame,
    identity: list[str],
    weights: tuple[float, ...] = (5, 2, 1),
    cap: float = 3.0,
) -> DataFrame:
    """`rows` (identity, source, size, base; narrow, already written) with their copies in the mix.

    Adds source_size, target, rate and copies. Rates are rounded within each source and base rate by
    systematic selection along the sizes: copies differ by at most one, and the tokens taken differ
    from rate * tokens by about one document. Sizes must not be NULL; a size of 0 takes part and
    gives no tokens. Equal rows are told apart by number only. Reruns agree.
    """
    targets = shared_targets(source_sizes(rows), weights, cap)
    cells = rows.groupBy("source", "base").agg(F.sum("size").cast("double").alias("tokens"))
    sources = balanced(cells, targets, cap)
    placed = numbered(rows, ["source", "base"], identity, "_place", first=["size"])
    joined = placed.alias("l").join(sources.alias("r"), same(["source"])).select(
        *[F.col(f"l.{c}") for c in dict.fromkeys([*identity, "source", "size", "base", "_place"])],
        "source_size", "target", "bound", "tilt",
    )
    rated = joined.withColumn("rate", rate(cap))
    part = F.col("rate") - F.floor("rate")
    # A half as the first phase; cells of other base rates start elsewhere, so their errors cancel.
    phase = F.when(F.col("base") == 1, 0.5).otherwise(F.pmod(F.xxhash64("base"), F.lit(1009)) / 1009.0)
    extra = F.floor(part * (F.col("_place") + 1) + phase) - F.floor(part * F.col("_place") + phase)
    return rated.withColumn("copies", F.floor("rate") + extra).drop("bound", "tilt", "_place")
