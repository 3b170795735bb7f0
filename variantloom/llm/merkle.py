"""Merkle manifest of a table: a tree of digests per group, a tree over the groups' roots, and proofs.

Levels are stored in bands of BAND: the node rows of band r hold, for each node of level BAND * r, the siblings
on its way up through that band and the link to the row above. A recursive query climbs these links
from every row, appends the siblings and folds the digest it was given up to the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.session import small_side, written

BAND = 6
WIDTH = 1 << BAND
# Rows of this many consecutive leaves share their node rows from the third band on.
BLOCK_BITS = 2 * BAND
RECURSION_ROWS = "spark.sql.cteRecursionRowLimit"

NODES = "tree bigint, rung int, at bigint, siblings binary, steps string, parent bigint, last boolean"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: "-" for NULL, else its UTF-8 length, ":" and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """SHA-256 of joined texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf(columns: Sequence[str], **changed: Column) -> Column:
    """Digest of a row's columns, in this order; `changed` gives other values for some of them."""
    return digest(*[field(changed.get(c, F.col(c))) for c in columns])


@dataclass
class Manifest:
    """A stored manifest.

    leaves: the rows given, with tree, place, and siblings and steps of their first band; trees: group, tree, size,
    subroot; nodes: the parent-linked rows of all bands above; top: the root, one row, or none for an empty table.
    Siblings are joined digests, steps say where each belongs: "l" left, "r" right, "-" none.
    """

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    top: DataFrame


def ordered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with tree (their group's number) and place (their own in it), and group, tree, size.

    Groups go by value, NULL first. Rows are dealt by range, so neither a group nor a run of
    equal rows has to fit one task: what is equal in `order` goes by its place in the written table.
    """
    rows = rows.withColumn("_row", F.col("_metadata.row_index"))
    keys = [group, *order, "_row"]
    dealt = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys])
    placed = written(dealt.withColumn("_part", F.spark_partition_id()), "merkle-order")
    counts = written(placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n")), "merkle-counts")
    # A group is numbered in the first range that holds it; ranges are few.
    groups = counts.groupBy(group).agg(F.min("_part").alias("_part"), F.sum("_n").alias("size"))
    new = groups.groupBy("_part").agg(F.count(F.lit(1)).alias("_new"))
    before = new.select("_part", (F.sum("_new").over(Window.orderBy("_part")) - F.col("_new")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(group).asc_nulls_first())) - 1
    trees = written(
        groups.join(before, "_part").select(group, (F.col("_before") + inside).cast("bigint").alias("tree"), "size"), "merkle-trees"
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.alias("s").join(trees.alias("t"), F.col(f"s.{group}").eqNullSafe(F.col(f"t.{group}"))).select(
        "s._part", F.col(f"s.{group}").alias("_group"), "_start", "tree", "size"
    )
    at = F.row_number().over(Window.partitionBy("_part", "tree").orderBy(*[F.col(c).asc_nulls_first() for c in [*order, "_row"]]))
    numbered = placed.alias("p").join(
        small_side(written(starts, "merkle-starts")).alias("s"),
        (F.col("p._part") == F.col("s._part")) & F.col(f"p.{group}").eqNullSafe(F.col("s._group")),
    )
    kept = [c for c in rows.columns if c != "_row"]
    out = numbered.select("p.*", "tree", "size", "_start").withColumn("place", (F.col("_start") + at - 1).cast("bigint"))
    return out.select(*kept, "tree", "size", "place"), trees


def halved(size: Column, times: int) -> Column:
    """How many nodes are left after so many levels."""
    return F.shiftright(size + ((1 << times) - 1), times)


def level_above(level: Column) -> Column:
    """Digests (hex) of each two consecutive ones, an odd last one alone."""
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)),
        lambda i: F.sha2(F.concat(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit(""))), 256),
    )


def band(nodes: DataFrame, name: str, payload: Sequence[str] = ()) -> DataFrame:
    """One band over nodes (tree, size, place, digest, payload): a row per WIDTH of them. Trees of one node end.

    tree, size, place (of the group), kids (place, payload, siblings, steps), digest (of the group's own node).
    """
    runs = nodes.filter("size > 1").groupBy("tree", "size", F.shiftright("place", BAND).alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("place", *payload, F.col("digest").alias("_digest")))).alias("run")
    )
    levels = runs.withColumn("_l0", F.transform("run", lambda x: hex_text(x["_digest"])))
    for j in range(BAND):
        above = F.when(halved(F.col("size"), j) > 1, level_above(F.col(f"_l{j}"))).otherwise(F.col(f"_l{j}"))
        levels = levels.withColumn(f"_l{j + 1}", above)

    def way(x: Column) -> Column:
        at = x["place"].cast("int").bitwiseAND(WIDTH - 1)
        told = [F.when(halved(F.col("size"), j) > 1, F.get(f"_l{j}", F.shiftright(at, j).bitwiseXOR(1))) for j in range(BAND)]
        steps = [
            F.when(halved(F.col("size"), j) <= 1, "").when(told[j].isNull(), "-").when(F.shiftright(at, j).bitwiseAND(1) == 1, "l").otherwise("r")
            for j in range(BAND)
        ]
        return F.struct(
            x["place"].alias("place"), *[x[c].alias(c) for c in payload], F.unhex(F.concat_ws("", *told)).alias("siblings"), F.concat(*steps).alias("steps")
        )

    return written(
        levels.select(
            "tree", "size", F.col("up").alias("place"), F.transform("run", way).alias("kids"), F.unhex(F.get(f"_l{BAND}", F.lit(0))).alias("digest")
        ),
        name,
    )


def bands(leaves: DataFrame, largest: int, name: str, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """All bands above leaves (tree, size, place, digest, payload), and the root of each tree (tree, digest)."""
    roots = [leaves.filter("size = 1").select("tree", "digest")]
    found, nodes = [], leaves
    while largest > 1:
        found.append(band(nodes, f"{name}-{len(found)}", () if found else payload))
        largest = -(-largest // WIDTH)
        nodes = found[-1].select("tree", halved(F.col("size"), BAND).alias("size"), "place", "digest")
        roots.append(nodes.filter("size = 1").select("tree", "digest"))
    return found, reduce(DataFrame.union, roots)


def band_count(size: Column) -> Column:
    """How many bands a tree of `size` leaves has; that of a single leaf has an empty one."""
    return reduce(lambda a, b: a + b, [(size > F.lit(1 << BAND * r).cast("bigint")).cast("int") for r in range(1, 10)], F.lit(1))


def node_rows(own: list[DataFrame], above: list[DataFrame], trees: DataFrame, n_trees: int) -> DataFrame:
    """The parent-linked rows above the leaves' first band.

    Band r of a tree is rung r, the bands over the trees follow. A row of the second band serves WIDTH leaves; above,
    there is a row for each block of leaves, so that no address is asked by more.
    """
    rows = []
    for r, groups in enumerate(own[1:], 1):
        kids = groups.select("tree", (halved(F.col("size"), BAND) == 1).alias("_top"), F.inline("kids"))
        spread = BAND * (r - 2)
        if r == 1:
            kids = kids.withColumn("at", F.col("place"))
        else:
            blocks = trees.select("tree", F.shiftright(F.col("size") - 1, BLOCK_BITS).alias("_last"))
            last = F.least("_last", F.shiftleft(F.col("place") + 1, spread) - 1)
            kids = kids.join(small_side(blocks), "tree").withColumn("at", F.explode(F.sequence(F.shiftleft("place", spread), last)))
        rows.append(kids.select("tree", F.lit(r).alias("rung"), "at", "siblings", "steps", (F.col("_top") & F.lit(n_trees == 1)).alias("last")))
    for j, groups in enumerate(above):
        kids = groups.select(F.inline("kids")).withColumnRenamed("place", "_place")
        each = trees.select("tree", "size", F.shiftright("tree", BAND * j).alias("_place"), (band_count(F.col("size")) + j).alias("rung"))
        blocks = F.when(F.col("rung") == 1, F.lit(0).cast("bigint")).otherwise(F.shiftright(F.col("size") - 1, BLOCK_BITS))
        placed = each.join(small_side(kids), "_place").withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)))
        rows.append(placed.select("tree", "rung", "at", "siblings", "steps", F.lit(j == len(above) - 1).alias("last")))
    if not rows:
        return trees.sparkSession.createDataFrame([], NODES)
    parent = F.when(F.col("rung") == 1, F.shiftright("at", BAND)).otherwise(F.col("at"))
    return reduce(DataFrame.unionByName, rows).select("tree", "rung", "at", "siblings", "steps", parent.alias("parent"), "last")


def build_manifest(rows: DataFrame, group: str, order: Sequence[str]) -> Manifest:
    """A tree over the rows' `digest` for each value of `group`, rows ascending by `order`, and one over the trees' roots.

    While several nodes remain, each two consecutive ones become the digest of their hex texts, an odd
    last one of its own. Groups go by value, NULL first. Rows equal in `order` and digest are
    interchangeable; those that differ go by digest. An empty table has no root. The table must not hold columns
    tree, size, place, siblings, steps, or any that start with "_".
    """
    numbered, trees = ordered(written(rows, "merkle-rows"), group, [*order, "digest"])
    payload = rows.columns
    numbered = numbered.select(*payload, "tree", "size", "place")
    sizes = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("size").alias("largest")).first()
    n_trees = sizes["trees"]
    own, subroots = bands(numbered, sizes["largest"] or 0, "merkle-band", payload)
    leaves = numbered.filter("size = 1").select(*payload, "tree", "place", F.lit(b"").alias("siblings"), F.lit("").alias("steps"))
    if own:
        leaves = leaves.unionByName(own[0].select("tree", F.inline("kids")))
    trees = written(trees.join(subroots, "tree").select(group, "tree", "size", F.col("digest").alias("subroot")), "merkle-subroots")
    crowns = trees.select(F.lit(0).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("size"), F.col("tree").alias("place"), F.col("subroot").alias("digest"))
    above, top = bands(crowns, n_trees, "merkle-crown")
    nodes = written(node_rows(own, above, trees, n_trees), "merkle-nodes")
    return Manifest(leaves, trees, nodes, top.select(F.col("digest").alias("root")))


@contextmanager
def unbounded_recursion(spark: SparkSession):
    """Recursive queries of this session may return any number of rows."""
    before = spark.conf.get(RECURSION_ROWS)
    spark.conf.set(RECURSION_ROWS, "-1")
    try:
        yield
    finally:
        spark.conf.set(RECURSION_ROWS, before)


FOLD = """aggregate(sequence(1, length({steps})), named_struct('f', {folded}, 'at', 1), (x, i) -> CASE substr({steps}, i, 1)
    WHEN '-' THEN named_struct('f', unhex(sha2(lower(hex(x.f)), 256)), 'at', x.at)
    WHEN 'l' THEN named_struct('f', unhex(sha2(lower(hex(concat(substring({siblings}, x.at, 32), x.f))), 256)), 'at', x.at + 32)
    ELSE named_struct('f', unhex(sha2(lower(hex(concat(x.f, substring({siblings}, x.at, 32)))), 256)), 'at', x.at + 32) END, x -> x.f)"""
# sequence(1, 0) would count down.
FOLD = "CASE WHEN {steps} = '' THEN {folded} ELSE " + FOLD + " END"
FIRST = FOLD.format(steps="steps", folded="claimed", siblings="siblings")
NEXT = FOLD.format(steps="n.steps", folded="c.folded", siblings="n.siblings")

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT {{kept}}, tree, 1 AS rung, shiftright(place, {BAND}) AS at, {FIRST} AS folded, siblings, alone AS done FROM {{{{claims}}}}
  UNION ALL
  SELECT {{held}}, c.tree, c.rung + 1, n.parent, {NEXT}, concat(c.siblings, n.siblings), n.last
  FROM climb c JOIN {{{{nodes}}}} n ON c.tree = n.tree AND c.rung = n.rung AND c.at = n.at
)
SELECT {{kept}}, tree, folded, siblings FROM climb WHERE done"""


def climbed(manifest: Manifest, claims: DataFrame, kept: Sequence[str]) -> DataFrame:
    """`kept`, tree, folded and siblings of every claim: a row of the manifest's leaves with a claimed digest.

    folded is the root that the claimed digest leads to; siblings are the digests met on the way, joined.
    A claim takes part in a join per band; no address there serves more than a block's rows.
    """
    alone = F.lit(manifest.nodes.isEmpty())  # no band above the first
    rows = claims.select(*kept, "tree", "place", "claimed", "siblings", "steps", alone.alias("alone"))
    spark = rows.sparkSession
    sql = CLIMB.format(kept=", ".join(kept), held=", ".join(f"c.{c}" for c in kept))
    with unbounded_recursion(spark):
        return written(spark.sql(sql, claims=rows, nodes=small_side(manifest.nodes)), "merkle-climb")


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """Every document's leaf, proof and check against the root, with some rows tampered with.

    Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Where 7 divides the CRC-32 of
    doc_id, the row is checked with n_chars one more. Rows without doc_id come first in their tree and are
    never tampered with; repeated rows are leaves of their own. Other columns of `docs` are left aside.
    """
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    changed = F.when(hit, leaf(LEAF, n_chars=F.col("n_chars") + 1))
    rows = docs.select("doc_id", "lang", leaf(LEAF).alias("digest"), changed.alias("changed"))
    manifest = build_manifest(rows, "lang", ["doc_id"])
    claims = manifest.leaves.withColumn("claimed", F.coalesce("changed", "digest"))
    proofs = climbed(manifest, claims, ["doc_id", "digest"])
    roots = proofs.join(small_side(manifest.trees.select("tree", "subroot")), "tree")
    root = manifest.top.select(hex_text(F.col("root"))).scalar()
    folded = hex_text(F.col("folded"))
    return roots.select(
        "doc_id",
        hex_text(F.col("digest")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(hex_text(F.col("siblings")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
