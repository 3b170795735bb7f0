"""Variant-shaped relations derived from the whole driver tables.

Each relation is one SQL text that Spark and DuckDB both run, so a query and its check
start from the same rows. `{name}` stands for a driver table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions.labels import col, quoted
from variantloom.session import discard, freed_shuffles, written
from variantloom.sources.vcf import Header

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def base(expr: str) -> str:
    """The nucleotide at a number modulo 4."""
    return f"SUBSTRING('ACGT', CAST(({expr}) % 4 AS INT) + 1, 1)"


EFFECT_CASE = """CASE {n} WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'intron_variant'
 WHEN 2 THEN 'splice_region_variant&intron_variant' WHEN 3 THEN 'mystery_variant'
 WHEN 4 THEN 'upstream_gene_variant' ELSE 'synonymous_variant' END"""
IMPACT_CASE = "CASE {n} WHEN 0 THEN 'MODERATE' WHEN 2 THEN 'LOW' WHEN 5 THEN 'LOW' ELSE 'MODIFIER' END"

# Cohort calls, one row per sample and variant; every supplier is a sample.
CALLS = f"""SELECT CONCAT('S', CAST(l_suppkey AS STRING)) AS sample,
  CONCAT('chr', CAST(l_partkey % 22 + 1 AS STRING)) AS chrom,
  1000 + l_partkey * 37 AS pos,
  {base('l_partkey')} AS ref,
  {base('l_partkey + 1 + l_linenumber % 3')} AS alt,
  CASE MAX(l_returnflag) WHEN 'R' THEN 'HOM' WHEN 'N' THEN 'HET' ELSE 'UNKWN' END AS zigosity,
  MIN(p_brand) AS gene_name,
  MIN(CONCAT('c.', CAST(l_linenumber AS STRING), 'A>G')) AS hgvs_c,
  MIN(CONCAT('p.Thr', CAST(l_linenumber AS STRING), 'Arg')) AS hgvs_p,
  MIN(CONCAT('rs', CAST(l_partkey AS STRING))) AS rsid,
  MIN({EFFECT_CASE.format(n='(l_partkey % 6)')}) AS effect,
  MIN({IMPACT_CASE.format(n='(l_partkey % 6)')}) AS impact,
  MIN(CASE WHEN l_partkey % 9 = 0 THEN 'INS' ELSE 'SNP' END) AS vartype,
  MIN(p_type) AS feature_id,
  MIN(l_quantity) AS qual
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
GROUP BY 1, 2, 3, 4, 5"""

# The same calls with one row per line item: several rows per sample and variant.
ROWS = f"""SELECT CONCAT('S', CAST(l_suppkey AS STRING)) AS sample,
  CONCAT('chr', CAST(l_partkey % 22 + 1 AS STRING)) AS chrom,
  1000 + l_partkey * 37 AS pos,
  {base('l_partkey')} AS ref,
  {base('l_partkey + 1 + l_linenumber % 3')} AS alt,
  CASE l_returnflag WHEN 'R' THEN 'HOM' WHEN 'N' THEN 'HET' ELSE 'UNKWN' END AS zigosity,
  p_brand AS gene_name,
  CONCAT('c.', CAST(l_linenumber AS STRING), 'A>G') AS hgvs_c,
  CONCAT('p.Thr', CAST(l_linenumber AS STRING), 'Arg') AS hgvs_p
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""


def family(sample: str) -> str:
    """Samples that share variants, one row per sample and variant."""
    return f"""SELECT {sample} AS sample,
  CONCAT('chr', CAST(l_orderkey % 22 + 1 AS STRING)) AS chrom,
  1000 + l_orderkey * 37 AS pos,
  {base('l_orderkey')} AS ref,
  {base('l_orderkey + 1 + l_linenumber % 3')} AS alt,
  CASE WHEN MIN(l_quantity) < 20 THEN 'HOM' ELSE 'HET' END AS zigosity,
  MIN(CONCAT('GENE', CAST(l_orderkey % 50 AS STRING))) AS gene_name,
  CASE WHEN MIN(l_tax) < 0.02 THEN 'missense_variant' ELSE 'intron_variant' END AS effect,
  CASE WHEN MIN(l_tax) < 0.02 THEN 'MODERATE' ELSE 'MODIFIER' END AS impact,
  MIN(CASE WHEN l_orderkey % 9 = 0 THEN 'INS' ELSE 'SNP' END) AS vartype,
  CASE WHEN MIN(l_suppkey) % 2 = 0 THEN MIN(CONCAT('rs', CAST(l_orderkey AS STRING))) END AS rsid,
  MIN(l_quantity) AS qual
FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5"""


TRIO_NAMES = ["TEST", "TEST2", "TEST3"]
DUO_NAMES = ["TEST", "TEST2"]
TRIO = family("CASE l_returnflag WHEN 'A' THEN 'TEST' WHEN 'N' THEN 'TEST2' ELSE 'TEST3' END")
DUO = family("CASE l_linestatus WHEN 'F' THEN 'TEST' ELSE 'TEST2' END")

# Sequencing reads and gene parts.
READS = """SELECT CONCAT('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS chrom,
  l_partkey * 100 AS start_pos, l_partkey * 100 + CAST(l_quantity AS BIGINT) AS end_pos
FROM {lineitem}"""
EXONS = """SELECT CONCAT('chr', CAST(p_partkey % 5 + 1 AS STRING)) AS chrom,
  p_partkey * 100 + 10 AS start_pos, p_partkey * 100 + 10 + p_size AS end_pos,
  CONCAT(p_brand, '_', CAST(p_partkey AS STRING)) AS gene_exon
FROM {part}"""
LENGTHS = """SELECT chrom, MAX(end_pos) + 50 AS length FROM (
  SELECT CONCAT('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS chrom,
    l_partkey * 100 + CAST(l_quantity AS BIGINT) AS end_pos FROM {lineitem}
  UNION ALL
  SELECT CONCAT('un', CAST(n_nationkey AS STRING)), 950 FROM {nation}) x GROUP BY chrom"""

# Chromosomes of 100 Mb that no read reaches, and exons all along them.
WIDE_EXONS = EXONS + """
UNION ALL SELECT CONCAT('un', CAST(p_partkey % 25 AS STRING)), p_partkey * 4000 + 10, p_partkey * 4000 + 10 + p_size,
  CONCAT(p_brand, '_', CAST(p_partkey AS STRING), 'u')
FROM {part}"""
WIDE_LENGTHS = LENGTHS.replace("950", "100000000")


def code(i: int) -> str:
    return f"((l_partkey + {i} * 3 + l_suppkey) % 6)"


def annotation(i: int, allele: str) -> str:
    """Columns of the i-th annotation of a record."""
    return f"""{allele} AS allele{i}, {EFFECT_CASE.format(n=code(i))} AS effect{i},
  {IMPACT_CASE.format(n=code(i))} AS impact{i},
  CONCAT('NM_', CAST({i} AS STRING)) AS feature{i},
  CASE WHEN {i} = 2 AND l_suppkey % 4 = 0 THEN 'n.null'
   ELSE CONCAT('c.', CAST(l_orderkey AS STRING), {base('l_orderkey')}, '>', {allele}) END AS hgvs_c{i},
  CASE {code(i)} WHEN 0 THEN CONCAT('p.Thr', CAST(l_orderkey AS STRING), 'Arg')
   WHEN 5 THEN 'p.Thr5Thr' ELSE '' END AS hgvs_p{i}"""


A1, A2 = base("l_orderkey + 1"), base("l_orderkey + 2")

# Annotated records: every line item, with repeated variants and two-allele records.
# Two records with equal ordinal and variant are equal in every column.
RECORDS = f"""SELECT CONCAT('P', CAST(l_linenumber AS STRING), l_returnflag) AS sample,
  (l_partkey * 10000000 + l_suppkey) * 64 + CAST(l_quantity AS BIGINT) AS ordinal,
  CONCAT('chr', CAST(l_orderkey % 22 + 1 AS STRING)) AS chrom,
  1000 + l_orderkey * 37 AS pos,
  CASE l_partkey % 3 WHEN 0 THEN '.' WHEN 1 THEN CONCAT('rs', CAST(l_orderkey AS STRING))
   ELSE CONCAT('COSM', CAST(l_orderkey AS STRING), ';rs', CAST(l_orderkey AS STRING)) END AS id,
  {base('l_orderkey')} AS ref,
  CASE l_partkey % 5 WHEN 0 THEN {A1} WHEN 1 THEN {A1} WHEN 2 THEN {A2} WHEN 3 THEN {A2}
   ELSE CONCAT({A1}, ',', {A2}) END AS alt,
  CAST(l_quantity AS DOUBLE) AS qual,
  CASE WHEN l_suppkey % 10 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter_status,
  CASE WHEN l_partkey % 5 = 4 THEN CONCAT(CAST(l_partkey % 2 + 1 AS STRING), ',', CAST(l_suppkey % 2 + 1 AS STRING))
   ELSE CAST(l_partkey % 2 + 1 AS STRING) END AS ac,
  CASE WHEN l_partkey % 5 = 4 THEN 'SNP,MNP' ELSE 'SNP' END AS vartype,
  CASE WHEN l_partkey % 5 = 4 THEN CONCAT('0.', LPAD(CAST(l_partkey % 100 AS STRING), 2, '0'), ',0.', LPAD(CAST(l_suppkey % 100 AS STRING), 2, '0'))
   ELSE CONCAT('0.', LPAD(CAST(l_partkey % 100 AS STRING), 2, '0')) END AS kg_af,
  CAST(l_suppkey % 150 + 1 AS STRING) AS build,
  CASE WHEN l_quantity < 20 THEN 'HOM' ELSE 'HET' END AS zigosity,
  CONCAT(CAST(l_partkey % 50 AS STRING), '.5,', CAST(l_suppkey % 50 AS STRING), '.25,',
   CASE WHEN l_partkey % 7 = 0 THEN '.' ELSE '1.0' END) AS maf,
  CASE l_suppkey % 3 WHEN 0 THEN '.' WHEN 1 THEN 'benign:0.1' ELSE 'possibly-damaging:0.9,benign:0.2' END AS ph,
  CASE WHEN l_partkey % 5 = 4 THEN '5,0' WHEN l_suppkey % 2 = 0 THEN '255|2' ELSE '.' END AS clnsig,
  CONCAT('GENE', CAST(l_orderkey % 50 AS STRING)) AS gene,
  l_partkey % 11 <> 0 AS annotated,
  {annotation(1, A1)},
  {annotation(2, A2)},
  {annotation(3, A1)}
FROM (SELECT DISTINCT l_linenumber, l_returnflag, l_orderkey, l_partkey, l_suppkey, l_quantity FROM {{lineitem}}) b"""

HEADER = Header(
    {
        "AC": "Integer", "VARTYPE": "Flag", "HOM": "Flag", "HET": "Flag", "dbSNPBuildID": "Integer",
        "1000Gp3_AF": "Float", "ESP6500_MAF": "String", "ESP6500_PH": "String",
        "CLINVAR_CLNSIG": "String", "ANN": "String",
    }
)


def check_sql(body: str, **relations: str) -> str:
    """SQL for the checker: named relations as CTEs over the plain driver tables."""
    names = {t: t for t in TABLES}
    ctes = ", ".join(f"{name} AS ({text.format(**names)})" for name, text in relations.items())
    return f"WITH {ctes} {body}" if ctes else body


def relation(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A relation as a Spark DataFrame."""
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


UPPER = {"hgvs_c": "HGVS.C", "hgvs_p": "HGVS.P", "start_pos": "START", "end_pos": "END"}
PLAIN = {
    "1000GP3_AF": "kg_af", "FILTER": "filter_status", "START": "start_pos", "END": "end_pos",
    "25%": "p25", "50%": "p50", "75%": "p75", "count": "n", "min": "lowest", "max": "highest",
    "_merge": "side",
}


def variants(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A relation under the library's column names."""
    df = relation(spark, sf_dir, text)
    return df.select(*[F.col(c).alias(UPPER.get(c, c.upper())) for c in df.columns])


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Columns (all, or the named ones) under simple lower-case names."""
    return df.select(
        *[col(c).alias(PLAIN.get(c, c.lower().replace(".", "_"))) for c in (names or df.columns)]
    )


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAMPLE, file, ordinal, line: the records as VCF text, one file per sample.

    The text is written once, as real VCF text would lie on storage.
    """
    entries = [
        f"concat_ws('|', allele{i}, effect{i}, impact{i}, gene, gene, 'transcript', feature{i}, 'Coding',"
        f" '1/1', hgvs_c{i}, hgvs_p{i}, '', '', '', '', '')"
        for i in (1, 2, 3)
    ]
    info = (
        "concat(if(pmod(ordinal, 640) = 0, 'AC=.;', ''), 'AC=', ac, ';', zigosity, ';VARTYPE=', vartype, ';dbSNPBuildID=', build,"
        " ';1000Gp3_AF=', kg_af, ';ESP6500_MAF=', maf, ';ESP6500_PH=', ph, ';CLINVAR_CLNSIG=', clnsig,"
        f" if(annotated, concat(';ANN=', concat_ws(',', {', '.join(entries)})), ''))"
    )
    lines = relation(spark, sf_dir, RECORDS).selectExpr(
        "sample AS SAMPLE",
        "concat(sample, '.vcf') AS file",
        "ordinal",
        f"concat_ws('\\t', chrom, pos, id, ref, alt, qual, filter_status, {info}, 'GT', '0/1') AS line",
    )
    return written(lines, "vcf-lines", "zstd")


def header_text(sample: str) -> list[str]:
    """Header lines of a VCF file, as SQL expressions; the last one names the sample."""
    defined = [
        f"'##INFO=<ID={name},Number=.,Type={kind},Description=\"-\">'"
        for name, kind in HEADER.types.items()
        if name != "ANN"
    ]
    fields = " | ".join(HEADER.ann_fields)
    ann = f"'##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: \\'{fields}\\' \">'"
    columns = f"concat('#CHROM\\tPOS\\tID\\tREF\\tALT\\tQUAL\\tFILTER\\tINFO\\tFORMAT\\t', {sample})"
    return ["'##fileformat=VCFv4.1'", *defined, ann, columns]


def write_vcf_files(spark: SparkSession, sf_dir: str, path: str, pieces: int | None = None) -> None:
    """VCF text files of all records below `path`; their number grows with the data unless `pieces` fixes it."""
    text = vcf_lines(spark, sf_dir)
    if pieces is None:
        pieces = 4 + text.count() // 2_000_000
    write_vcf_text(text, path, pieces)
    discard(text)


def write_vcf_text(text: DataFrame, path: str, pieces: int, empty: DataFrame | None = None, head: list[str] | None = None) -> None:
    """Lines (SAMPLE, ordinal, line) as `pieces` gzip files per sample, each with its header (`head`: SQL expressions).

    A variant's records stay in one file and in their order. Samples of `empty` get a header only.
    """
    lines = text.selectExpr(
        "SAMPLE",
        f"pmod(hash(substring_index(line, '\\t', 2)), {pieces}) AS piece",
        "1 AS part",
        "ordinal",
        "line",
    )
    files = lines.select("SAMPLE", "piece").distinct()
    if empty is not None:
        files = files.unionByName(empty.selectExpr("SAMPLE", "0 AS piece"))
    heads = (
        files.selectExpr("SAMPLE", "piece", "0 AS part", f"posexplode(array({', '.join(head or header_text('SAMPLE'))})) AS (ordinal, line)")
        .withColumn("ordinal", F.col("ordinal").cast("bigint"))
        .filter("line <> ''")
    )
    dealt = lines.unionByName(heads).repartition("SAMPLE", "piece").sortWithinPartitions("SAMPLE", "piece", "part", "ordinal")
    with freed_shuffles(text.sparkSession):
        dealt.select("SAMPLE", "piece", "line").write.partitionBy("SAMPLE", "piece").text(path, compression="gzip")
