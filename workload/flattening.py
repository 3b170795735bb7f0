"""Queries for reading and flattening annotated records, and for the scalar rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions import labels as L
from variantloom.operators import flatten as X
from variantloom.operators.cohort import to_calls
from variantloom.plans.jobs import add_sample, build_cohort, cohort_size, parse_vcf
from variantloom.session import discard, scratch_path
from variantloom.sources import sinks
from variantloom.sources.tables import read_cohort_parquet
from variantloom.sources.vcf import gathered, parse_records
from variantloom.streaming.cohort_stream import stream_cohort
from workload import query
from workload.relations import (
    HEADER,
    RECORDS,
    check_sql,
    header_text,
    plain,
    relation,
    vcf_lines,
    write_vcf_files,
    write_vcf_text,
)

# Steps of the expected result, as SQL over the record relation `r`.
LAST = """last_record AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY sample, chrom, pos, ref, alt ORDER BY ordinal DESC) AS rn FROM r) x WHERE rn = 1)"""


def part(name: str, i: int) -> str:
    return f"CASE WHEN {name} LIKE '%,%' THEN SPLIT_PART({name}, ',', {i}) ELSE {name} END AS own_{name}"


def alleles(source: str) -> str:
    per = ["ac", "vartype", "kg_af", "clnsig"]
    return f"""allele_rows AS (
  SELECT *, 0 AS idx, SPLIT_PART(alt, ',', 1) AS allele, {', '.join(part(c, 1) for c in per)} FROM {source}
  UNION ALL
  SELECT *, 1 AS idx, SPLIT_PART(alt, ',', 2) AS allele, {', '.join(part(c, 2) for c in per)} FROM {source}
  WHERE alt LIKE '%,%')"""


ANNOTATIONS = "annotation_rows AS (" + " UNION ALL ".join(
    f"""SELECT *, {i} AS entry, allele{i} AS ann_allele, effect{i} AS effect, impact{i} AS impact,
  feature{i} AS feature_id, hgvs_c{i} AS hgvs_c, hgvs_p{i} AS hgvs_p FROM allele_rows WHERE annotated"""
    for i in (1, 2, 3)
) + ")"
RANK = """CASE SPLIT_PART(effect, '&', 1) WHEN 'missense_variant' THEN 14 WHEN 'splice_region_variant' THEN 15
 WHEN 'synonymous_variant' THEN 18 WHEN 'intron_variant' THEN 24 WHEN 'upstream_gene_variant' THEN 26 ELSE 1000 END"""
FIRST = f"""chosen AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY sample, chrom, pos, ref, allele
  ORDER BY CASE WHEN ann_allele = allele THEN 0 ELSE 1 END, {RANK}, ordinal, idx, entry) AS place
  FROM annotation_rows) x WHERE place = 1)"""
FIELDS = """sample, chrom, pos, ref, allele AS alt,
  NULLIF(id, '.') AS rsid, qual, filter_status, CAST(own_ac AS BIGINT) AS ac, zigosity,
  own_vartype AS vartype, ROUND(CAST(own_kg_af AS DOUBLE), 6) AS kg_af, CAST(build AS BIGINT) AS dbsnpbuildid,
  ROUND(CAST(SPLIT_PART(maf, ',', 1) AS DOUBLE) / 100, 6) AS esp6500_maf_ea,
  ROUND(CAST(SPLIT_PART(maf, ',', 2) AS DOUBLE) / 100, 6) AS esp6500_maf_aa,
  ROUND(TRY_CAST(SPLIT_PART(maf, ',', 3) AS DOUBLE) / 100, 6) AS esp6500_maf_all,
  CASE WHEN ph <> '.' THEN SPLIT_PART(ph, ':', 1) END AS polyphen_pred,
  CASE WHEN ph <> '.' THEN SPLIT_PART(SPLIT_PART(ph, ':', 2), ',', 1) END AS polyphen_score,
  CASE own_clnsig WHEN '5' THEN 'Pathogenic' WHEN '0' THEN 'Uncertain significance'
   WHEN '255|2' THEN 'other|Benign' END AS clinvar_clnsig,
  gene AS gene_name, effect, impact, feature_id,
  CASE WHEN hgvs_c NOT LIKE '%null%' THEN hgvs_c END AS hgvs_c, NULLIF(hgvs_p, '') AS hgvs_p,
  CASE WHEN hgvs_p LIKE '%Arg' THEN 'CHANGE' ELSE '.' END AS aminochange"""
NAMES = [
    "SAMPLE", "CHROM", "POS", "REF", "ALT", "RSID", "QUAL", "FILTER", "AC", "ZIGOSITY", "VARTYPE",
    "1000GP3_AF", "DBSNPBUILDID", "ESP6500_MAF_EA", "ESP6500_MAF_AA", "ESP6500_MAF_ALL",
    "POLYPHEN_PRED", "POLYPHEN_SCORE", "CLINVAR_CLNSIG", "GENE_NAME", "EFFECT", "IMPACT",
    "FEATURE_ID", "HGVS.C", "HGVS.P", "AMINOCHANGE",
]


def steps(*ctes: str, select: str) -> str:
    head = check_sql("", r=RECORDS).strip()
    return f"{head}, {', '.join(ctes)} {select}" if ctes else f"{head} {select}"


FLAT_SQL = steps(LAST, alleles("last_record"), ANNOTATIONS, FIRST, select=f"SELECT {FIELDS} FROM chosen")
ALL_SQL = steps(LAST, alleles("last_record"), ANNOTATIONS, select=f"SELECT {FIELDS}, ann_allele AS allele FROM annotation_rows")
CALLS_SQL = steps(
    LAST, alleles("last_record"), ANNOTATIONS, FIRST,
    select="""SELECT sample, chrom, pos, ref, allele AS alt, zigosity, gene AS gene_name,
  CASE WHEN hgvs_c NOT LIKE '%null%' THEN hgvs_c END AS hgvs_c, NULLIF(hgvs_p, '') AS hgvs_p FROM chosen""",
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(vcf_lines(spark, sf_dir), list(HEADER.types))


def flat(spark: SparkSession, sf_dir: str, prioritized: bool = True) -> DataFrame:
    return X.flatten_records(records(spark, sf_dir), HEADER, prioritized)


def flat_whole(spark: SparkSession, sf_dir: str, prioritized: bool = True) -> DataFrame:
    """The same where all columns are wanted: the text is shuffled once."""
    lines = gathered(vcf_lines(spark, sf_dir))
    return X.flatten_records(parse_records(lines, list(HEADER.types)), HEADER, prioritized)


def vcf_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "vcf")
    write_vcf_files(spark, sf_dir, path)
    return path


@query("flatten_vcf", FLAT_SQL)
def flatten_vcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(flat_whole(spark, sf_dir), *NAMES)


@query("flatten_all_annotations", ALL_SQL)
def flatten_all_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(flat_whole(spark, sf_dir, prioritized=False), *NAMES, "ALLELE")


@query("read_vcf_files", FLAT_SQL)
def read_vcf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF text files, written first, read with headers and sample names taken from the files."""
    path = vcf_folder(spark, sf_dir)
    return plain(X.flatten_vcf(spark, path, recursive=True, glob="*.txt.gz", together=True), *NAMES)


@query(
    "read_vcf_records",
    steps(select="""SELECT sample, chrom, pos, NULLIF(id, '.') AS id, ref, alt, qual, filter_status, ac, vartype,
  kg_af, NULLIF(ph, '.') AS esp6500_ph, CASE WHEN zigosity = 'HOM' THEN 'True' END AS hom FROM r"""),
)
def read_vcf_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        records(spark, sf_dir).withColumnRenamed("1000Gp3_AF", "1000GP3_AF"),
        "SAMPLE", "CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "AC", "VARTYPE",
        "1000GP3_AF", "ESP6500_PH", "HOM",
    )


@query(
    "dedupe_variants",
    steps(LAST, select="SELECT sample, chrom, pos, ref, alt, ordinal, ac, qual FROM last_record"),
)
def dedupe_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = X.dedupe_variants(records(spark, sf_dir))
    return plain(kept, "SAMPLE", "CHROM", "POS", "REF", "ALT", "ordinal", "AC", "QUAL")


@query(
    "split_multiallelic",
    steps(alleles("r"), select="""SELECT sample, ordinal, chrom, pos, ref, allele AS alt, CAST(idx AS INTEGER) AS allele_index,
  own_ac AS ac, own_vartype AS vartype, own_kg_af AS kg_af, build AS dbsnpbuildid FROM allele_rows"""),
)
def split_multiallelic(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = X.split_multiallelic(records(spark, sf_dir)).withColumnRenamed("1000Gp3_AF", "1000GP3_AF")
    return plain(
        split, "SAMPLE", "ordinal", "CHROM", "POS", "REF", "ALT", "ALLELE_INDEX", "AC", "VARTYPE",
        "1000GP3_AF", "dbSNPBuildID",
    )


@query(
    "split_first_rest",
    steps(alleles("r"), select="""SELECT sample, ordinal, chrom, pos, ref, allele AS alt, own_ac AS ac,
  own_clnsig AS clnsig FROM (SELECT * REPLACE (NULLIF(own_clnsig, '.') AS own_clnsig) FROM allele_rows) x"""),
)
def split_first_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records have at most two alleles, so the first-and-rest mode gives the same rows."""
    split = X.split_multiallelic(records(spark, sf_dir), mode="first_rest")
    return plain(split, "SAMPLE", "ordinal", "CHROM", "POS", "REF", "ALT", "AC", "CLINVAR_CLNSIG").withColumnRenamed(
        "clinvar_clnsig", "clnsig"
    )


@query(
    "explode_annotations",
    steps(*[ANNOTATIONS.replace("FROM allele_rows", "FROM r")], select="""SELECT sample, ordinal, chrom, pos, ref, alt,
  CAST(entry - 1 AS INTEGER) AS ann_index, ann_allele AS allele, effect AS annotation, impact AS annotation_impact,
  gene AS gene_name, NULLIF(hgvs_p, '') AS hgvs_p FROM annotation_rows"""),
)
def explode_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.explode_annotations(records(spark, sf_dir), HEADER.ann_fields)
    return plain(
        rows, "SAMPLE", "ordinal", "CHROM", "POS", "REF", "ALT", "ANN_INDEX", "Allele", "Annotation",
        "Annotation_Impact", "Gene_Name", "HGVS.p",
    )


@query(
    "prioritize",
    steps(
        ANNOTATIONS.replace("FROM allele_rows", "FROM (SELECT *, alt AS allele, 0 AS idx FROM r) y"),
        FIRST,
        select="SELECT sample, chrom, pos, ref, alt, ann_allele AS allele, effect AS annotation, hgvs_c FROM chosen",
    ),
)
def prioritize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.explode_annotations(records(spark, sf_dir), HEADER.ann_fields)
    best = X.prioritize(rows, ["SAMPLE", "CHROM", "POS", "REF", "ALT"], position=["ordinal", "ANN_INDEX"])
    return plain(best, "SAMPLE", "CHROM", "POS", "REF", "ALT", "Allele", "Annotation", "HGVS.c")


CUSTOM = {"upstream_gene_variant": 1, "intron_variant": 2, "mystery_variant": 3}


@query(
    "prioritize_custom_ranks",
    steps(
        ANNOTATIONS.replace("FROM allele_rows", "FROM (SELECT *, alt AS allele, 0 AS idx FROM r) y"),
        FIRST.replace(
            RANK,
            """CASE SPLIT_PART(effect, '&', 1) WHEN 'upstream_gene_variant' THEN 1 WHEN 'intron_variant' THEN 2
 WHEN 'mystery_variant' THEN 3 ELSE 1000 END, SPLIT_PART(effect, '&', 1)""",
        ),
        select="SELECT sample, chrom, pos, ref, alt, effect AS annotation FROM chosen",
    ),
)
def prioritize_custom_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's ranks; terms outside them come last, by text."""
    rows = X.explode_annotations(records(spark, sf_dir), HEADER.ann_fields)
    best = X.prioritize(rows, ["SAMPLE", "CHROM", "POS", "REF", "ALT"], CUSTOM, ["ordinal", "ANN_INDEX"])
    return plain(best, "SAMPLE", "CHROM", "POS", "REF", "ALT", "Annotation")


@query(
    "effect_severity",
    steps(ANNOTATIONS.replace("FROM allele_rows WHERE annotated", "FROM r"), select="""SELECT effect, CAST(CASE SPLIT_PART(effect, '&', 1) WHEN 'missense_variant' THEN 14
  WHEN 'splice_region_variant' THEN 15 WHEN 'synonymous_variant' THEN 18 WHEN 'intron_variant' THEN 24
  WHEN 'upstream_gene_variant' THEN 26 END AS INTEGER) AS severity, COUNT(*) AS n FROM annotation_rows GROUP BY 1, 2"""),
)
def effect_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    effects = relation(spark, sf_dir, RECORDS).select(F.explode(F.array("effect1", "effect2", "effect3")).alias("effect"))
    return effects.groupBy("effect", L.effect_rank(F.col("effect")).alias("severity")).agg(F.count(F.lit(1)).alias("n"))


def change_sql(i: int) -> str:
    return f"""hgvs_p{i}, CASE WHEN LEFT(REPLACE(hgvs_p{i}, 'p.', ''), 3)
  <> RIGHT(REPLACE(hgvs_p{i}, 'p.', ''), 3) THEN 'CHANGE' ELSE '.' END AS aminochange{i}"""


@query("amino_change", steps(select=f"SELECT sample, ordinal, pos, {', '.join(change_sql(i) for i in (1, 2, 3))} FROM r"))
def amino_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    changes = [c for i in (1, 2, 3) for c in (F.col(f"hgvs_p{i}"), L.amino_change(F.col(f"hgvs_p{i}")).alias(f"aminochange{i}"))]
    return r.select("sample", "ordinal", "pos", *changes)


@query(
    "hgvs_and_zygosity",
    steps(select=f"""SELECT sample, ordinal, pos, {', '.join(f"CASE WHEN hgvs_c{i} NOT LIKE '%null%' THEN hgvs_c{i} END AS hgvs_c{i}" for i in (1, 2, 3))},
  CASE WHEN zigosity = 'HOM' THEN 'HOM' ELSE 'HET' END AS zigosity FROM r"""),
)
def hgvs_and_zygosity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    return r.select(
        "sample", "ordinal", "pos", *[L.clean_hgvs_c(F.col(f"hgvs_c{i}")).alias(f"hgvs_c{i}") for i in (1, 2, 3)],
        L.zygosity(F.col("zigosity") == "HOM").alias("zigosity"),
    )


@query(
    "esp_frequencies",
    steps(select="""SELECT sample, ordinal, pos, ROUND(CAST(SPLIT_PART(maf, ',', 1) AS DOUBLE) / 100, 6) AS ea,
  ROUND(CAST(SPLIT_PART(maf, ',', 2) AS DOUBLE) / 100, 6) AS aa,
  ROUND(TRY_CAST(SPLIT_PART(maf, ',', 3) AS DOUBLE) / 100, 6) AS overall FROM r"""),
)
def esp_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    maf = F.col("maf")
    return r.select(
        "sample", "ordinal", "pos", L.esp_frequency(maf, 0).alias("ea"), L.esp_frequency(maf, 1).alias("aa"),
        L.esp_frequency(maf, 2).alias("overall"),
    )


@query(
    "polyphen_split",
    steps(select="""SELECT sample, ordinal, pos, NULLIF(TRIM(SPLIT_PART(ph, ':', 1), '.,'), '') AS prediction,
  NULLIF(SPLIT_PART(SPLIT_PART(ph, ':', 2), ',', 1), '') AS score FROM r"""),
)
def polyphen_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    return r.select(
        "sample", "ordinal", "pos", L.polyphen_prediction(F.col("ph")).alias("prediction"),
        L.polyphen_score(F.col("ph")).alias("score"),
    )


@query(
    "clinvar_labels",
    steps(select="""SELECT sample, ordinal, pos, CASE clnsig WHEN '5,0' THEN 'Pathogenic,Uncertain significance'
  WHEN '255|2' THEN 'other|Benign' ELSE clnsig END AS clnsig FROM r"""),
)
def clinvar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    return r.select("sample", "ordinal", "pos", L.clinvar_labels(F.col("clnsig")).alias("clnsig"))


@query(
    "coerce_numeric",
    steps(select="""SELECT sample, ordinal, pos, ROUND(TRY_CAST(kg_af AS DOUBLE), 6) AS kg_af,
  TRY_CAST(ac AS BIGINT) AS ac, TRY_CAST(id AS BIGINT) AS id_number FROM r"""),
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relation(spark, sf_dir, RECORDS)
    return r.select(
        "sample", "ordinal", "pos", L.to_double(F.col("kg_af")).alias("kg_af"),
        L.to_integer(F.col("ac")).alias("ac"), L.to_integer(F.col("id")).alias("id_number"),
    )


@query(
    "finalize_strings",
    steps(
        LAST, alleles("last_record"), ANNOTATIONS, FIRST,
        select=f"""SELECT sample, chrom, pos, ref, alt, COALESCE(rsid, '.') AS rsid,
  COALESCE(clinvar_clnsig, '.') AS clinvar_clnsig, COALESCE(hgvs_c, '.') AS hgvs_c, COALESCE(hgvs_p, '.') AS hgvs_p,
  CAST(ac AS VARCHAR) AS ac, COALESCE(polyphen_pred, '.') AS polyphen_pred FROM (SELECT {FIELDS} FROM chosen) y""",
    ),
)
def finalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        X.finalize_strings(flat(spark, sf_dir)),
        "SAMPLE", "CHROM", "POS", "REF", "ALT", "RSID", "CLINVAR_CLNSIG", "HGVS.C", "HGVS.P", "AC", "POLYPHEN_PRED",
    )


@query("write_flat_csv", f"SELECT sample, chrom, pos, ref, alt, COALESCE(rsid, '.') AS rsid, COALESCE(hgvs_p, '.') AS hgvs_p, effect FROM ({FLAT_SQL}) y")
def write_flat_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flat-csv")
    sinks.write_flat_csv(flat_whole(spark, sf_dir), path)
    back = spark.read.csv(path, header=True).withColumn("POS", F.col("POS").cast("bigint"))
    return plain(back, "SAMPLE", "CHROM", "POS", "REF", "ALT", "RSID", "HGVS.P", "EFFECT")


@query("parse_vcf_to_parquet", FLAT_SQL)
def parse_vcf_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to flat parquet partitioned by sample and chromosome."""
    path, out = vcf_folder(spark, sf_dir), scratch_path(spark, "flat-parquet")
    parse_vcf(spark, path, out, "parquet", recursive=True, partition_by=["SAMPLE", "CHROM"], glob="*.txt.gz")
    back = spark.read.parquet(out)
    return plain(back, *NAMES)


@query("build_and_add_sample", CALLS_SQL)
def build_and_add_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cohort of all samples but one, extended by the last one."""
    calls = to_calls(flat(spark, sf_dir))
    path = scratch_path(spark, "cohort")
    sinks.write_cohort(calls.filter("SAMPLE <> 'P7R'"), path)
    add_sample(spark, calls.filter("SAMPLE = 'P7R'"), path)
    return plain(read_cohort_parquet(spark, path))


@query("stream_cohort", CALLS_SQL)
def stream_cohort_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cohort built by a stream over a folder of VCF files, two per sample, in several batches."""
    folder = scratch_path(spark, "stream-in")
    write_vcf_files(spark, sf_dir, folder, pieces=2)
    cohort, checkpoint = scratch_path(spark, "stream-cohort"), scratch_path(spark, "stream-checkpoint")
    stream_cohort(spark, folder, cohort, checkpoint, HEADER, files_per_batch=11, glob="*.txt.gz").awaitTermination()
    return plain(read_cohort_parquet(spark, cohort))


# Files that differ: those of N samples have no annotations, those of R declare a text where others
# declare a number, and those of A hold a key that no header declares.
MIXED_FIELDS = FIELDS.replace(
    "CAST(build AS BIGINT) AS dbsnpbuildid",
    "CASE WHEN sample LIKE '%R' THEN 'b' || build ELSE build END AS dbsnpbuildid, CASE WHEN sample LIKE '%A' THEN '7' END AS newkey",
)
NO_ANNOTATION = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("effect", "impact", "feature_id", "hgvs_c", "hgvs_p"))
MIXED_SQL = steps(
    LAST, alleles("last_record"), ANNOTATIONS, FIRST,
    select=f"""SELECT {MIXED_FIELDS} FROM chosen WHERE sample NOT LIKE '%N'
  UNION ALL SELECT {MIXED_FIELDS} FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS gene), {NO_ANNOTATION} FROM allele_rows WHERE sample LIKE '%N') n""",
)


@query("flatten_mixed_files", MIXED_SQL.replace("allele_rows AS (", "allele_rows AS MATERIALIZED ("))
def flatten_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated and unannotated files, files that disagree about a type, and undeclared keys, read together."""
    lines = vcf_lines(spark, sf_dir)
    text = lines.withColumn(
        "line",
        F.when(F.col("SAMPLE").endswith("N"), F.regexp_replace("line", ";ANN=[^\t]*", ""))
        .when(F.col("SAMPLE").endswith("R"), F.replace("line", F.lit("dbSNPBuildID="), F.lit("dbSNPBuildID=b")))
        .otherwise(F.replace("line", F.lit(";dbSNPBuildID="), F.lit(";NEWKEY=7;dbSNPBuildID="))),
    )
    head = []
    for line in header_text("SAMPLE"):
        if "ID=ANN," in line:
            line = f"if(endswith(SAMPLE, 'N'), '', {line})"
        elif "ID=dbSNPBuildID," in line:
            line = f"if(endswith(SAMPLE, 'R'), {line.replace('Integer', 'String')}, {line})"
        head.append(line)
    path = scratch_path(spark, "mixed")
    write_vcf_text(text, path, 2, head=head)
    discard(lines)
    return plain(X.flatten_vcf(spark, path, recursive=True, glob="*.txt.gz", together=True), *NAMES, "NEWKEY")


# Samples of line 1 also have a processed file, with homozygous records only, that supersedes the raw one.
BUILT = """SELECT * REPLACE (CASE WHEN sample LIKE 'P1%' THEN sample || '_proc' ELSE sample END AS sample)
  FROM every WHERE sample NOT LIKE 'P1%' OR zigosity = 'HOM'"""


def superseded_samples(spark: SparkSession, sf_dir: str) -> str:
    """A folder of those files, and of five samples without a variant."""
    text = vcf_lines(spark, sf_dir)
    processed = text.filter("SAMPLE LIKE 'P1%' AND contains(line, ';HOM;')").withColumn("SAMPLE", F.concat("SAMPLE", F.lit("_proc")))
    empty = spark.read.parquet(f"{sf_dir}/region.parquet").selectExpr("concat('E', r_regionkey) AS SAMPLE")
    folder = scratch_path(spark, "samples")
    write_vcf_text(text.unionByName(processed, allowMissingColumns=True), folder, 1, empty)
    discard(text)
    return folder


@query(
    "build_cohort",
    f"""{check_sql("", every=RECORDS, r=BUILT).strip()}, {LAST}, {alleles("last_record")}, {ANNOTATIONS}, {FIRST}
  SELECT sample, chrom, pos, ref, allele AS alt, zigosity, gene AS gene_name,
  CASE WHEN hgvs_c NOT LIKE '%null%' THEN hgvs_c END AS hgvs_c, NULLIF(hgvs_p, '') AS hgvs_p,
  (SELECT COUNT(DISTINCT sample) FROM r) + (SELECT COUNT(*) FROM region) AS n_samples, CAST(0 AS BIGINT) AS again FROM chosen""",
)
def build_cohort_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files named unlike their samples, some superseded, some without a variant, ingested twice.

    n_samples counts the samples without variants; `again` is how many files the second run ingests.
    """
    folder, cohort = superseded_samples(spark, sf_dir), scratch_path(spark, "cohort")
    build_cohort(spark, folder, cohort, "_proc", ending=".txt.gz")
    again = build_cohort(spark, folder, cohort, "_proc", ending=".txt.gz")
    calls = plain(read_cohort_parquet(spark, cohort))
    return calls.withColumns({"n_samples": F.lit(cohort_size(spark, cohort)).cast("bigint"), "again": F.lit(again).cast("bigint")})
