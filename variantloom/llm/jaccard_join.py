"""Exact Jaccard self-join on word shingles with a token-group matrix.

Texts with equal shingle sets become one set. Every set keeps a prefix: its rarest shingles, so many
that two sets at the threshold share one. Each set is compared with the set that it shares most
prefix tokens with; what agrees forms groups. The token-group matrix holds the union of each group's
prefix tokens; its counts bound how much a set can share with any member of a group, and only groups
whose bound reaches the threshold are opened and compared exactly. Every link between different
texts is either found or lies within a group, so the components are exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm import text as T
from variantloom.llm.components import components
from variantloom.session import small_side, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Counters of the sketch that tells frequent shingles from rare ones: the model's fixed size.
COUNTERS = 1 << 22


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text; the whole sequence if it has fewer words."""
    w = T.words(column, lower=True)
    grams = T.ngrams(w.hashes, n)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= n:
            g = np.sort(grams[a : b - n + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif b > a:
            out.append(T.seeded(T.ngrams(w.hashes[a:b], int(b - a)), int(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_hashes(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Per text its set's size and 128-bit hash; at the end the task's frequent counters."""
    counters = np.zeros(COUNTERS, dtype=np.int32)
    names = ["doc_id", "n", "s1", "s2", "counter", "count"]
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            sets = shingle_sets(piece.column("text"), n)
            rows = len(sets)
            with np.errstate(over="ignore"):
                s1 = np.array([T.seeded(s, 1).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                s2 = np.array([T.seeded(s, 2).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            every = np.concatenate(sets) if rows else np.zeros(0, dtype=np.uint64)
            at, times = np.unique((every % np.uint64(COUNTERS)).astype(np.int64), return_counts=True)
            counters[at] += times.astype(np.int32)
            arrays = [
                piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(T.signed(s1)), pa.array(T.signed(s2)),
                pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    at = np.flatnonzero(counters >= max(2, 2 + 2 * counters.mean()))
    for part in np.array_split(at, len(at) // 50_000 + 1):
        arrays = [pa.nulls(len(part), pa.int64())] * 4 + [pa.array(part.astype(np.int32)), pa.array(counters[part].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def levels(counts: DataFrame) -> np.ndarray:
    """How frequent the shingles of each counter are, on a scale of powers of two; a fixed-size table.

    It only orders the shingles. Whatever it holds, the join is exact; rarer prefixes make it faster.
    """
    out = np.zeros(COUNTERS, dtype=np.uint8)
    sums = counts.filter("counter IS NOT NULL").groupBy("counter").agg(F.sum("count").alias("count")).filter("count >= 4")
    # At most one row a counter.
    table = sums.select("counter", F.least(F.floor(F.log2("count")) - 1, F.lit(63)).cast("int").alias("level")).toArrow()
    out[table["counter"].to_numpy()] = table["level"].to_numpy()
    return out


def ranked(shingles: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Shingles of a set from the rarest level on, in hash order within a level."""
    lifted = level[(shingles % np.uint64(COUNTERS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
    return shingles[np.argsort(lifted | (T.mix(shingles) >> np.uint64(6)), kind="stable")]


def prefix_size(size: int, percent: int) -> int:
    """Tokens of which a partner at the threshold must share one: a partner holds percent of the set."""
    return size - -(-percent * size // 100) + 1


def similar(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return inter * 100 >= (a + b - inter) * percent


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def needed(a: Column, b: Column, percent: int) -> Column:
    """Shared tokens that two sets of these sizes need."""
    return F.ceil((a + b) * percent / F.lit(100 + percent) - F.lit(1e-9))


def rest(a: Column, percent: int) -> Column:
    """Tokens of a set behind its prefix."""
    return F.ceil(a * percent / F.lit(100) - F.lit(1e-9)) - 1


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs` (doc_id long, text).

    Two texts link if their sets of n-word shingles (A-Z in lower case) have a Jaccard similarity of
    at least `percent`/100. component_id is the smallest doc_id that links reach, its own included.
    A text without words (or NULL) has an empty set and links with nothing. Rows with the same doc_id
    are one document. A row without doc_id gets the component of an equal text, else NULL, and links
    nothing. Repeated rows stay; other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    T.small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    hashed = written(
        texts.mapInArrow(lambda b: set_hashes(b, n), "doc_id bigint, n bigint, s1 bigint, s2 bigint, counter int, count bigint"), "sets"
    )
    level = spark.sparkContext.broadcast(levels(hashed))
    rows = hashed.filter("counter IS NULL").select("doc_id", "n", "s1", "s2")
    key = ["s1", "s2", "n"]
    equal = written(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("id")), "equal")

    groups = linked_groups(texts, rows, equal, level, n, percent)
    named = equal.alias("e").join(groups.alias("g"), F.col("id") == F.col("node"), "left").select(
        *key, F.coalesce("component", "id").alias("component")
    )
    return rows.join(named, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def prefix_rows(batches: Iterable[pa.RecordBatch], n: int, percent: int, level: np.ndarray) -> Iterator[pa.RecordBatch]:
    """token, id, n for the prefix of every text's set."""
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            sets = shingle_sets(piece.column("text"), n)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            kept = [ranked(s, level)[: prefix_size(len(s), percent)] if len(s) else s for s in sets]
            counts = np.array([len(k) for k in kept], dtype=np.int64)
            ids = piece.column("doc_id").take(pa.array(np.repeat(np.arange(len(sets)), counts)))
            tokens = np.concatenate(kept) if kept else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(tokens)), ids, pa.array(np.repeat(sizes, counts))], names=["token", "id", "n"]
            )


def set_rows(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """id and the whole shingle set of every text."""
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            sets = shingle_sets(piece.column("text"), n)
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(T.signed(values)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], names=["id", "tokens"])


def linked_groups(texts: DataFrame, rows: DataFrame, equal: DataFrame, level, n: int, percent: int) -> DataFrame:
    """node, component over the ids of different sets that link."""
    present = texts.filter("doc_id IS NOT NULL")
    # A document stands for its set unless an equal one has a smaller id.
    copies = rows.filter("doc_id IS NOT NULL AND n > 0").join(equal, ["s1", "s2", "n"]).filter("doc_id <> id")
    copies = written(copies.select(F.col("doc_id").alias("id"), "n"), "copies")
    prefixes = present.mapInArrow(lambda b: prefix_rows(b, n, percent, level.value), "token bigint, id bigint, n bigint")
    prefixes = prefixes.join(small_side(copies), ["id", "n"], "left_anti")
    often = prefixes.groupBy("token").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).filter("_lo <> _hi")
    shared = written(prefixes.join(often.select("token"), "token").select("token", "id", "n"), "prefixes")

    # The prefixes of different sets, as one array each: a tenth or a fifth of the whole sets.
    prefix = written(shared.groupBy("id").agg(F.max("n").alias("n"), F.collect_set("token").alias("prefix")), "prefixes")

    def checked(pairs: DataFrame) -> DataFrame:
        return verified(written(plausible(pairs, prefix, percent), "pairs"), present, n, percent)

    found = checked(nearest(shared, percent))
    groups = written(components(found), "groups")
    member = prefix.select("id", "n").join(groups, F.col("id") == F.col("node"), "left")
    member = written(member.select("id", "n", F.coalesce("component", "id").alias("group")), "members")
    more = checked(opened(shared, member, percent))
    # Links between groups join whole groups.
    group_of = member.select("id", "group").distinct()
    between = (
        more.join(group_of.select(F.col("id").alias("a"), F.col("group").alias("ga")), "a")
        .join(group_of.select(F.col("id").alias("b"), F.col("group").alias("gb")), "b")
        .select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    )
    merged = components(between)
    return (
        group_of.join(merged, F.col("group") == F.col("node"), "left")
        .select(F.col("id").alias("node"), F.coalesce("component", "group").alias("component"))
        .groupBy("node").agg(F.min("component").alias("component"))
    )


def nearest(shared: DataFrame, percent: int) -> DataFrame:
    """a, b: for each set the token leader that it shares most prefix tokens with.

    A token's leader is its smallest id among sets of about the same size, so pairs are as few as sets.
    """
    band = F.floor(F.log(F.col("n")) / F.lit(-np.log(percent / 100) if percent < 100 else 1.0))
    rows = shared.withColumn("band", band)
    leaders = rows.groupBy("token", "band").agg(F.min("id").alias("leader"))
    pairs = rows.join(leaders, ["token", "band"]).filter("id <> leader")
    counted = pairs.groupBy("id", "leader").agg(F.count(F.lit(1)).alias("k"))
    return counted.groupBy("id").agg(F.max_by("leader", F.struct("k", -F.col("leader"))).alias("b")).select(F.col("id").alias("a"), "b")


def opened(shared: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of a set and a member of another group that the token-group matrix cannot rule out."""
    tagged = shared.join(member, ["id", "n"]).select("token", "id", "n", "group")
    matrix = tagged.groupBy("token", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    query, other = tagged.alias("q"), matrix.alias("m")
    # Each pair of groups is looked at from the side of the larger id.
    fit = (F.col("m.group") < F.col("q.group")) & (F.col("m.high") * 100 >= F.col("q.n") * percent) & (F.col("q.n") * 100 >= F.col("m.low") * percent)
    hits = query.join(other, (F.col("q.token") == F.col("m.token")) & fit).groupBy(
        F.col("q.id").alias("a"), F.col("q.n").alias("n"), F.col("m.group").alias("group")
    ).agg(F.count(F.lit(1)).alias("k"))
    span = member.groupBy("group").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    low = F.greatest(F.col("low"), F.ceil(F.col("n") * percent / F.lit(100) - F.lit(1e-9)))
    high = F.least(F.col("high"), F.floor(F.col("n") * 100 / F.lit(percent) + F.lit(1e-9)))
    # The set whose prefix ends first has all shared tokens of its prefix in the other's prefix, so the
    # shared tokens are at most k plus what lies behind that prefix.
    open_groups = hits.join(span, "group").filter((low <= high) & (F.col("k") >= group_bound(F.col("n"), low, high, percent)))
    open_groups = open_groups.select("a", F.col("n").alias("na"), "group")
    members = member.select(F.col("id").alias("b"), F.col("n").alias("nb"), "group")
    return open_groups.join(members, "group").filter(sizes_fit(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()


def group_bound(n: Column, low: Column, high: Column, percent: int) -> Column:
    """Shared prefix tokens that a set of n needs with any member of low ... high tokens, or fewer."""
    # needed() less rest() of the member is more than (n + s) p / (100 + p) - s p / 100. Unrounded it falls
    # with s; rounded up it does not, so the whole number after its value at `high` is the bound.
    behind = F.floor((n * 100 - high * percent) * percent / F.lit(100 * (100 + percent))) + 1
    return F.least(needed(n, low, percent) - rest(n, percent), behind)


def plausible(pairs: DataFrame, prefix: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share enough: the set whose prefix ends first has all its shared prefix
    tokens in the other's prefix, so no more can be shared than these and what lies behind it."""
    a = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    b = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
    both = pairs.join(a, "a").join(b, "b").filter(sizes_fit(F.col("na"), F.col("nb"), percent))
    least = needed(F.col("na"), F.col("nb"), percent) - F.greatest(rest(F.col("na"), percent), rest(F.col("nb"), percent))
    return both.filter(F.size(F.array_intersect("pa", "pb")) >= least).select("a", "b")


def verified(pairs: DataFrame, present: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar; only the texts of `pairs` (written) are read for it."""
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
    texts = present.join(small_side(wanted), F.col("doc_id") == F.col("id"), "left_semi")
    sets = written(texts.mapInArrow(lambda b: set_rows(b, n), "id bigint, tokens array<bigint>"), "tokens")
    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b")
    inter = F.size(F.array_intersect("ta", "tb"))
    return both.filter(similar(inter, F.size("ta"), F.size("tb"), percent)).select("a", "b")
