"""Ranked lexical search: MaxScore over an index of term postings, with joint maxima of term pairs as bounds.

A query's terms are taken in pairs. What a pair can add to a score is bounded by the largest single impact
or, if some document holds both, by the largest joint one; both come from the index. The cheapest
pairs whose bounds together stay below the score of TOP known documents are not essential: documents
that hold no other term cannot rank, so only the essential terms' postings are opened.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.llm.text import pieces, row_sums, signed, small_batches, words
from variantloom.session import is_small, small_side, written

# Tasks get these helpers with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 50
# Documents whose scores set a query's first threshold: those on its rarest lists, about so many.
SEEDS = 500
# Pairs get an intersection list if their two posting lists together hold at most this share of all documents.
PAIR_SHARE = 1 / 64
# Terms that tasks hold to leave other postings out at once; beyond, a join does it alone.
HELD_TERMS = 1 << 20

SEPARATES = np.ones(256, dtype=bool)
SEPARATES[128:] = False
for _first, _last in ("09", "AZ", "az"):
    SEPARATES[ord(_first) : ord(_last) + 1] = False


def term_lists(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The columns before `text`, the number of terms, and the distinct ones (all, or those wanted) with their counts."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            w = words(piece.column("text"), lower=True, separators=SEPARATES)
            row, term, count = row_sums(w.row_of(), w.hashes)
            if wanted is not None and len(term):
                at = np.minimum(np.searchsorted(wanted, term), max(len(wanted) - 1, 0))
                kept = wanted[at] == term if len(wanted) else np.zeros(len(term), dtype=bool)
                row, term, count = row[kept], term[kept], count[kept]
            offsets = np.searchsorted(row, np.arange(len(piece) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (signed(term), count.astype(np.int32))]
            columns = [piece.column(i) for i in range(piece.num_columns - 1)]
            names = piece.schema.names[:-1]
            yield pa.record_batch([*columns, pa.array(w.counts().astype(np.int64)), *lists], [*names, "n", "terms", "counts"])


def listed(table: DataFrame, key: str, wanted: np.ndarray | None = None) -> DataFrame:
    """key, n, terms, counts of every row."""
    small_batches(table.sparkSession)
    rows = table.select(key, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lambda batches: term_lists(batches, wanted), f"`{key}` {kind}, n bigint, terms array<bigint>, counts array<int>")


def held(vocabulary: DataFrame) -> np.ndarray | None:
    """The vocabulary as a sorted array if it is small, else None."""
    if not is_small(vocabulary, HELD_TERMS):
        return None
    return np.sort(np.array([r[0] for r in vocabulary.collect()], dtype=np.int64).view(np.uint64))


@dataclass
class Index:
    """Forward rows (row, doc_id, m, terms, counts), terms (term, df, w, most), and the pairs' joint maxima (a, b, joint)."""

    documents: DataFrame
    terms: DataFrame
    pairs: DataFrame


def impact(tf: Column, m: Column) -> Column:
    tf = tf.cast("bigint")
    return F.call_function("div", tf * 1_000_000_000, tf * 1000 + m * 20)


def postings(documents: DataFrame) -> DataFrame:
    """row, term, hit: a term's saturated frequency in a document, before its weight."""
    each = documents.select("row", "m", F.inline(F.arrays_zip("terms", "counts")).alias("term", "tf"))
    return each.select("row", "term", impact(F.col("tf"), F.col("m")).alias("hit"))


def weight(df: Column, n: int) -> Column:
    return F.floor(F.log((F.lit(2 * n + 2).cast("double")) / (df * 2 + 1).cast("double")) * 1000).cast("bigint")


def forward(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, int]:
    """Forward rows of the documents with terms, and how many there are. Terms outside the vocabulary are left out."""
    all_rows = listed(docs.select("doc_id", "text"), "doc_id", held(vocabulary))
    stored = written(all_rows.filter("n > 0").withColumn("row", F.monotonically_increasing_id()), "search-forward")
    total = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    m = F.lit(50).cast("bigint") + F.call_function("div", F.col("n") * (50 * total["n"]), F.lit(max(total["words"], 1)))
    return stored.filter("size(terms) > 0").select("row", "doc_id", m.alias("m"), "terms", "counts"), total["n"]


def build_index(docs: DataFrame, queries: DataFrame) -> Index:
    """The index of all documents for the terms of `queries` (query, term)."""
    vocabulary = written(queries.select("term").distinct(), "search-vocabulary")
    documents, n = forward(docs, vocabulary)
    hits = postings(documents).join(small_side(vocabulary), "term")
    sums = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("hit").alias("_hit"))
    w = weight(F.col("df"), n)
    terms = written(sums.select("term", "df", w.alias("w"), (w * F.col("_hit")).alias("most")), "search-terms")
    return Index(documents, terms, joint_maxima(documents, terms, query_pairs(queries, terms), n))


def query_pairs(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """query, pair, a, b: each query's terms by falling maximum, two by two; b is NULL for an odd last one."""
    known = queries.join(small_side(terms), "term")
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.col("most").desc(), "term")) - 1
    two = known.withColumn("_at", order).groupBy("query", F.shiftright("_at", 1).alias("pair"))
    return two.agg(F.min("term").alias("a"), F.when(F.count(F.lit(1)) > 1, F.max("term")).alias("b"))


def joint_maxima(documents: DataFrame, terms: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """a, b, joint: the largest joint impact in a document that holds both, 0 if none does; for listed pairs."""
    ends = [terms.select(F.col("term").alias(c), F.col("df").alias(f"_df_{c}"), F.col("w").alias(f"_w_{c}")) for c in "ab"]
    both = pairs.filter("b IS NOT NULL").select("a", "b").distinct()
    sized = both.join(small_side(ends[0]), "a").join(small_side(ends[1]), "b").filter(F.col("_df_a") + F.col("_df_b") <= n * PAIR_SHARE)
    sized = written(sized, "search-pairs")
    sides = sized.select("a", "b", F.inline(F.array(*[F.struct(F.col(c).alias("term"), F.col(f"_w_{c}").alias("w")) for c in "ab"])))
    found = postings(documents).join(small_side(sides), "term").groupBy("a", "b", "row")
    lists = found.agg(F.count(F.lit(1)).alias("_ends"), F.sum(F.col("w") * F.col("hit")).alias("joint")).filter("_ends = 2")
    most = lists.groupBy("a", "b").agg(F.max("joint").alias("joint"))
    return written(sized.join(most, ["a", "b"], "left").select("a", "b", F.coalesce("joint", F.lit(0)).alias("joint")), "search-joint")


def exact_scores(pairs: DataFrame, documents: DataFrame, weights: DataFrame) -> DataFrame:
    """query, row, doc_id, score of (query, row), from whole documents; `weights` has query, term, w."""
    each = pairs.join(documents, "row").select(
        "query", "row", "doc_id", "m", F.inline(F.arrays_zip("terms", "counts")).alias("term", "tf")
    )
    hits = each.join(small_side(weights), ["query", "term"])
    return hits.groupBy("query", "row", "doc_id").agg(F.sum(F.col("w") * impact(F.col("tf"), F.col("m"))).alias("score")).filter("score > 0")


def first_threshold(index: Index, weights: DataFrame, top: int) -> DataFrame:
    """query, least: the score of its top-th document among those on its rarest lists; none with fewer documents."""
    rarest = Window.partitionBy("query").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    lists = weights.withColumn("_before", F.coalesce(F.sum("df").over(rarest), F.lit(0))).filter(F.col("_before") < SEEDS)
    opened = postings(index.documents).join(small_side(lists.select("query", "term")), "term").select("query", "row").distinct()
    scores = exact_scores(opened, index.documents, weights)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))
    return scores.withColumn("_place", place).filter(F.col("_place") == top).select("query", F.col("score").alias("least"))


def essential_terms(index: Index, queries: DataFrame, weights: DataFrame, thresholds: DataFrame) -> DataFrame:
    """query, term, w, least, rest: the terms to open, the threshold, and what all other terms can add at most."""
    pairs = query_pairs(queries, index.terms)
    most = [index.terms.select(F.col("term").alias(c), F.col("most").alias(f"_most_{c}")) for c in "ab"]
    known = pairs.join(small_side(most[0]), "a").join(small_side(most[1]), "b", "left").join(small_side(index.pairs), ["a", "b"], "left")
    apart = F.greatest("_most_a", F.coalesce("_most_b", F.lit(0)))
    bound = F.when(F.col("joint").isNotNull(), F.greatest(apart, F.col("joint"))).otherwise(F.col("_most_a") + F.coalesce("_most_b", F.lit(0)))
    rising = Window.partitionBy("query").orderBy("_bound", "pair").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = known.withColumn("_bound", bound).withColumn("_sum", F.sum("_bound").over(rising))
    told = summed.join(small_side(thresholds), "query", "left").withColumn("least", F.coalesce("least", F.lit(1)))
    shut = F.when(F.col("_sum") < F.col("least"), F.col("_sum"))
    rest = F.coalesce(F.max(shut).over(Window.partitionBy("query")), F.lit(0))
    open_pairs = told.withColumn("rest", rest).filter(F.col("_sum") >= F.col("least"))
    opened = open_pairs.select("query", "least", "rest", F.explode(F.array("a", "b")).alias("term")).filter("term IS NOT NULL")
    return opened.join(weights.select("query", "term", "w"), ["query", "term"])


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """query, rank, doc_id, score: the `top` best documents of every item, scores above 0 only.

    docs has doc_id and text, items have query and text. Terms are runs of ASCII letters and digits and of all other
    characters beyond ASCII, A-Z lower-cased. The score is the sum over an item's distinct terms of w *
    ((1000000000 * tf) div (1000 * tf + 20 * m)), m = 50 + (50 * n * N) div L. NULL and empty texts have no terms
    and never rank; an item without known terms has no rows. Equal scores go by ascending doc_id, NULL first; rows that
    repeat rank one by one; items that repeat a query are one item of all their terms. Terms are told apart by 64-bit hashes.
    """
    split = listed(items.select("query", "text"), "query").select("query", F.explode("terms").alias("term")).distinct()
    queries = written(split, "search-queries")
    index = build_index(docs, queries)
    weights = written(queries.join(small_side(index.terms), "term").select("query", "term", "df", "w"), "search-weights")
    thresholds = written(first_threshold(index, weights, top), "search-thresholds")
    opened = written(essential_terms(index, queries, weights, thresholds), "search-opened")
    partial = postings(index.documents).join(small_side(opened), "term").groupBy("query", "row").agg(
        F.sum(F.col("w") * F.col("hit")).alias("_part"), F.first("least").alias("least"), F.first("rest").alias("rest")
    )
    able = written(partial.filter(F.col("_part") + F.col("rest") >= F.col("least")).select("query", "row"), "search-able")
    scores = exact_scores(able, index.documents, weights)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "row")
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query", "rank", "doc_id", "score")
