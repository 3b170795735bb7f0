"""A training-data pipeline: five stages over the documents, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm.decontamination import decontaminated
from variantloom.llm.jaccard_join import jaccard_components
from variantloom.llm.mixing import mixed
from variantloom.llm.quality_classifier import quality_scores
from variantloom.llm.registry import table
from variantloom.llm.sharding import assign_shards
from variantloom.llm.text import WORD, word_array
from variantloom.session import small_side, written

SHARDS = 16
OWN = "__pipeline_"  # names of columns that live inside a stage
ORACLE_SQL = None  # learned scores, word alignment and the jump hash's order are tested by brute force


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Rows without doc_id stay."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    rejected = scores.filter("predicted = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(small_side(written(rejected, "rejected")), "doc_id", "left_anti").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the smallest doc_id.

    Rows equal in doc_id and text are one document. A row without doc_id goes if another row with words equals it; of
    equal ones without doc_id one stays. Documents without words, and rows like no other, stay.
    """
    groups = jaccard_components(docs, n=5, percent=80)
    copies = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(small_side(written(copies, "copies")), "doc_id", "left_anti")
    text = F.coalesce("text", F.lit(""))
    hashes = {f"{OWN}h1": F.xxhash64(text), f"{OWN}h2": F.xxhash64(F.lit(1), text), f"{OWN}words": text.rlike(WORD)}
    same = written(
        docs.select("doc_id", *[v.alias(k) for k, v in hashes.items()]).groupBy("doc_id", *hashes).agg(F.count(F.lit(1)).alias("n")), "same"
    )
    named = same.filter(F.col("doc_id").isNotNull()).select(f"{OWN}h1", f"{OWN}h2").distinct()
    unnamed = same.filter(F.col("doc_id").isNull() & F.col(f"{OWN}words"))
    gone = unnamed.join(named, [f"{OWN}h1", f"{OWN}h2"], "left_semi").withColumn(f"{OWN}once", F.lit(False))
    left = unnamed.join(named, [f"{OWN}h1", f"{OWN}h2"], "left_anti").unionByName(same.filter("doc_id IS NOT NULL"))
    once = left.filter("n > 1").withColumn(f"{OWN}once", F.lit(True))
    odd = written(gone.unionByName(once).drop("n", f"{OWN}words"), "odd").select(F.col("doc_id").alias(f"{OWN}id"), F.col(f"{OWN}h1").alias(f"{OWN}r1"), F.col(f"{OWN}h2").alias(f"{OWN}r2"), f"{OWN}once")
    told = kept.withColumns(hashes)
    is_odd = (
        F.col("doc_id").eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}h1") == F.col(f"{OWN}r1")) & (F.col(f"{OWN}h2") == F.col(f"{OWN}r2"))
    )
    side = small_side(odd)
    plain = told.join(side, is_odd, "left_anti")
    firsts = told.join(side.filter(f"{OWN}once"), is_odd, "left_semi").dropDuplicates(["doc_id", f"{OWN}h1", f"{OWN}h2"])
    return plain.unionByName(firsts).select(docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row for each copy, none for what it leaves out."""
    identity = ["doc_id", "text_id"]
    text = F.coalesce("text", F.lit(""))
    told = docs.withColumn(f"{OWN}text_id", F.xxhash64(text))
    rows = told.select(
        "doc_id", F.col(f"{OWN}text_id").alias("text_id"), "source", F.size(word_array(F.col("text"))).cast("bigint").alias("size"), F.lit(1.0).alias("base")
    )
    taken = mixed(written(rows, "sizes"), identity)
    # Rows equal in id, text and source are taken together.
    copies = written(taken.groupBy("doc_id", "text_id", "source").agg(F.sum("copies").alias(f"{OWN}copies"), F.count(F.lit(1)).alias(f"{OWN}rows")), "copies")
    same = (
        F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col(f"l.{OWN}text_id") == F.col("r.text_id")) & F.col("l.source").eqNullSafe(F.col("r.source"))
    )
    once = copies.filter(f"{OWN}rows = 1 AND {OWN}copies > 0")
    out = told.alias("l").join(once.alias("r"), same).select(*[F.col(f"l.{c}") for c in docs.columns], f"{OWN}copies")
    several = copies.filter(f"{OWN}rows > 1 AND {OWN}copies > 0")
    repeated = told.alias("l").join(small_side(several).alias("r"), same).select(*[F.col(f"l.{c}") for c in docs.columns], f"{OWN}copies", f"{OWN}text_id")
    first = repeated.dropDuplicates(["doc_id", f"{OWN}text_id", "source"]).drop(f"{OWN}text_id")
    return spread(out.unionByName(first)).select(docs.columns)


def spread(rows: DataFrame) -> DataFrame:
    """A row for each of its copies."""
    return rows.withColumn(f"{OWN}copy", F.explode(F.expr(f"sequence(1, {OWN}copies)")))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the shard of its doc_id."""
    return assign_shards(docs, SHARDS)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_leaks),
    ("mixing sources", mix),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
