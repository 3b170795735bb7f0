"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm import checks
from variantloom.llm.class_lm import lm_scores
from variantloom.llm.decontamination import contaminated
from variantloom.llm.jaccard_join import jaccard_components
from variantloom.llm.lexical_search import search
from variantloom.llm.license_scan import licence_paragraphs
from variantloom.llm.line_dedup import deduplicated
from variantloom.llm.merkle import manifest_proofs
from variantloom.llm.mixing import mixed
from variantloom.llm.page_text import page_texts
from variantloom.llm.quality_classifier import quality_scores
from variantloom.llm.quality_rules import judged
from variantloom.llm.registry import query, table
from variantloom.llm.sharding import jump_hash, shard_slots
from variantloom.llm.substring_dedup import repeated_passages
from variantloom.llm.text import word_array
from variantloom.session import written


@query("op3_line_quality", checks.LINE_QUALITY)
def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).drop("clean_text")


SHARDS = 16


@query("op4_jump_shards", checks.JUMP_SHARDS)
def jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(F.col("doc_id"), SHARDS).alias("shard"),
        jump_hash(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )
    narrow = written(rows, "shards")
    return shard_slots(narrow, ["doc_id", "size", "text_crc32", "law", "grown_shard"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query("op7_entropy_mix", checks.ENTROPY_MIX)
def entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(word_array(F.col("text"))).cast("bigint").alias("size"), F.lit(1.0).alias("base")
    )
    mix = mixed(written(rows, "sizes"), ["doc_id"])
    return mix.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


@query("op5_qda_quality")
def qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_jaccard_groups", checks.JACCARD_GROUPS)
def jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


@query("op1_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_line_dedup", checks.LINE_DEDUP)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_dropped").cast("bigint").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op6_class_lm")
def class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query("op2_repeated_passages")
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op10_licences")
def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_paragraphs(table(spark, sf_dir, "documents"))


@query("op11_page_text")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


@query("op12_merkle_manifest", checks.MERKLE_PROOFS)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_proofs(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", checks.LEXICAL_SEARCH)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    return search(table(spark, sf_dir, "documents"), items).withColumnRenamed("query", "item_id")
