"""Queries for indexed files, checksummed differences, header lengths, file comparison and delivery manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.names import KEY
from variantloom.operators import checksums as X
from variantloom.plans import jobs as J
from variantloom.session import scratch_path
from variantloom.sources import files as FS
from variantloom.sources import zone_index as Z
from variantloom.sources.vcf import contig_lengths, header_lines, read_lines
from workload import CHECKS, query
from workload.analyses import DIFF_SQL, ENDS, ID, KEY_NAMES, depth_sql, reads
from workload.flattening import FLAT_SQL
from workload.relations import CALLS, DUO, DUO_NAMES, LENGTHS, check_sql, plain, relation, variants, vcf_lines, write_vcf_text


def indexed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The calls as sorted files of a thousand rows at most, and their index."""
    path = scratch_path(spark, "sorted-calls")
    Z.write_sorted(variants(spark, sf_dir, CALLS), path, rows_per_file=1_000)
    Z.write_index(spark, path, path + "-index", ["RSID"])
    return path, path + "-index"


@query("indexed_point_lookup", CHECKS["point_lookup"])
def indexed_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Z.indexed_lookup(spark, *indexed(spark, sf_dir), "chr8", 1000 + 29 * 37), "SAMPLE", *KEY_NAMES, "ZIGOSITY")


@query("indexed_chromosome_slice", CHECKS["chromosome_slice"])
def indexed_chromosome_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Z.indexed_slice(spark, *indexed(spark, sf_dir), "chr7"), "SAMPLE", *KEY_NAMES, "ZIGOSITY")


@query("indexed_identifier", check_sql(f"SELECT sample, {ID}, rsid FROM c WHERE rsid = 'rs29'", c=CALLS))
def indexed_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(Z.indexed_identifier(spark, *indexed(spark, sf_dir), "RSID", "rs29"), "SAMPLE", *KEY_NAMES, "RSID")


@query("differing_rows", check_sql(f"SELECT * FROM ({DIFF_SQL}) d WHERE n_left <> n_right", t=DUO))
def differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples' rows that are not held equally often, found by bucket checksums."""
    t = J.sample_tables(variants(spark, sf_dir, DUO), DUO_NAMES)
    return plain(X.differing_rows(t["TEST"].select(*KEY, "RSID"), t["TEST2"].select("RSID", *KEY, "EFFECT")))


CHANGED = "SELECT * REPLACE (CASE WHEN pos % 97 = 0 THEN 'HOM' ELSE zigosity END AS zigosity) FROM c"


@query(
    "differing_calls",
    check_sql(
        f"""SELECT sample, {ID}, zigosity, CAST(SUM(l) AS BIGINT) AS n_left, CAST(SUM(1 - l) AS BIGINT) AS n_right,
  CASE WHEN SUM(l) > 0 THEN 'left_only' ELSE 'right_only' END AS side
  FROM (SELECT sample, {ID}, zigosity, 1 AS l FROM c UNION ALL SELECT sample, {ID}, zigosity, 0 FROM ({CHANGED}) d) x
  GROUP BY sample, {ID}, zigosity HAVING SUM(l) <> SUM(1 - l)""",
        c=CALLS,
    ),
)
def differing_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cohort against itself with a few genotypes changed: nearly all buckets are equal."""
    calls = variants(spark, sf_dir, CALLS).select("SAMPLE", *KEY, "ZIGOSITY")
    changed = calls.withColumn("ZIGOSITY", F.when(F.col("POS") % 97 == 0, "HOM").otherwise(F.col("ZIGOSITY")))
    return plain(X.differing_rows(calls, changed))


@query("contig_lengths", depth_sql("SELECT chrom, start_pos, end_pos, depth FROM runs", ENDS, lengths=LENGTHS))
def contig_lengths_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth runs up to the chromosome ends that VCF headers declare."""
    path = scratch_path(spark, "contigs")
    lengths = relation(spark, sf_dir, LENGTHS)
    contigs = lengths.select(F.format_string("##contig=<ID=%s,length=%d,assembly=x>", "chrom", "length").alias("value"))
    contigs.write.text(path)
    found = contig_lengths(header_lines(read_lines(spark, path, recursive=True, glob="*.txt")))
    return plain(J.depth_runs(reads(spark, sf_dir), found, bin_width=1 << 12))


PAIR = ["P1R", "P2R"]
# Without a place, the report of two files shows all regions.
DIFF_REPORT = f"""WITH f AS ({FLAT_SQL}), p AS (SELECT * FROM f WHERE sample IN ('P1R', 'P2R'))
SELECT chrom, pos, ref, alt, MIN(gene_name) AS gene_name,
  MAX(CASE WHEN sample = 'P1R' THEN zigosity END) AS zigosity_p1r, MAX(CASE WHEN sample = 'P2R' THEN zigosity END) AS zigosity_p2r
FROM p GROUP BY chrom, pos, ref, alt"""


@query("diffvcf", DIFF_REPORT)
def diffvcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two VCF files compared; the report's data table read back."""
    folder, out = scratch_path(spark, "pair"), scratch_path(spark, "diff-report")
    write_vcf_text(vcf_lines(spark, sf_dir).filter(F.col("SAMPLE").isin(PAIR)), folder, 1)
    listed = FS.list_files(spark, folder, "*.txt").filter("length > 0").select("path").orderBy("path")
    J.comparison_report(spark, [row["path"] for row in listed.collect()], out)
    data = spark.read.csv(f"{out}/data", header=True).withColumn("POS", F.col("POS").cast("bigint"))
    return plain(data, *KEY, "GENE_NAME", "ZIGOSITY_P1R", "ZIGOSITY_P2R")


@query(
    "read_manifest",
    """SELECT 'https://host/x/' || s_suppkey || '.tar' AS url, s_suppkey || '.tar' AS name, md5(s_name) AS md5 FROM supplier""",
)
def read_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address sheet: links (formulas, archives and others), a title, then checksums in the order of the archives."""
    rows = relation(
        spark, sf_dir,
        """SELECT s_suppkey AS row, CASE WHEN s_suppkey % 2 = 0 THEN CONCAT('=HYPERLINK("https://host/x/', s_suppkey, '.tar","file")')
      ELSE CONCAT('https://host/x/', s_suppkey, '.tar') END AS address FROM {supplier}
    UNION ALL SELECT s_suppkey, CONCAT('https://host/x/', s_suppkey, '.txt') FROM {supplier}
    UNION ALL SELECT 10000000, 'md5sum'
    UNION ALL SELECT 20000000 + s_suppkey, UPPER(MD5(s_name)) FROM {supplier}
    UNION ALL SELECT -1, 'download address'""",
    )
    return FS.read_manifest(rows)
