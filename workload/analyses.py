"""Queries for panels, comparisons, the cohort, statistics, intervals, reports and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.functions import labels as L
from variantloom.names import KEY, REPORT_COLUMNS, VENDOR_COLUMNS
from variantloom.operators import cohort as C
from variantloom.operators import filters as P
from variantloom.operators import intervals as I
from variantloom.operators import report as R
from variantloom.operators import stats as S
from variantloom.operators import venn as V
from variantloom.plans import jobs as J
from variantloom.session import scratch_path, written
from variantloom.sources import files as FS
from variantloom.sources import sinks as K
from variantloom.sources import tables as T
from workload import query
from workload.relations import (
    CALLS,
    DUO,
    DUO_NAMES,
    EXONS,
    LENGTHS,
    READS,
    ROWS,
    TRIO,
    TRIO_NAMES,
    WIDE_EXONS,
    WIDE_LENGTHS,
    base,
    check_sql,
    plain,
    relation,
    variants,
)

ID = "chrom, pos, ref, alt"
KEY_NAMES = ["CHROM", "POS", "REF", "ALT"]


# ---- panel, text rules, lookups -------------------------------------------------

PANEL = ["Brand#3", "Brand#12", "Brand#14", "Brand#21", "Brand#25"]
PANEL_SQL = ", ".join(f"'{g}'" for g in PANEL)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a table: listed genes that occur in the part table."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.filter(F.col("p_brand").isin(PANEL)).select(F.col("p_brand").alias("GeneSymbol")).distinct()


@query("panel_filter", check_sql(f"SELECT sample, {ID}, gene_name FROM c WHERE gene_name IN ({PANEL_SQL})", c=CALLS))
def panel_filter(spark, sf_dir):
    kept = P.panel_filter(variants(spark, sf_dir, CALLS), panel(spark, sf_dir))
    return plain(kept, "SAMPLE", *KEY_NAMES, "GENE_NAME")


@query(
    "panel_order",
    check_sql(
        f"SELECT sample, {ID}, gene_name, CAST(CASE gene_name "
        + " ".join(f"WHEN '{g}' THEN {i}" for i, g in enumerate(PANEL))
        + f" END AS INTEGER) AS panel_position FROM c WHERE gene_name IN ({PANEL_SQL})",
        c=CALLS,
    ),
)
def panel_order(spark, sf_dir):
    places = reduce(
        lambda rest, pair: F.when(F.col("GeneSymbol") == pair[1], F.lit(pair[0])).otherwise(rest),
        enumerate(PANEL), F.lit(None).cast("int"),
    )
    positions = panel(spark, sf_dir).withColumn("PANEL_POSITION", places)
    return plain(
        P.panel_order(variants(spark, sf_dir, CALLS), positions), "SAMPLE", *KEY_NAMES, "GENE_NAME", "PANEL_POSITION"
    )


@query("read_panel", "SELECT DISTINCT p_brand AS genesymbol FROM part")
def read_panel(spark, sf_dir):
    path = scratch_path(spark, "panel") + ".csv"
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    parts.select(F.col("p_brand").alias("GeneSymbol"), "p_size").write.csv(path, header=True)
    return plain(T.read_panel(spark, path))


@query(
    "text_filter",
    check_sql(
        f"SELECT sample, {ID}, zigosity, effect FROM c WHERE NOT regexp_matches(zigosity, 'HOM') AND NOT regexp_matches(effect, 'intron|up.*gene')",
        c=CALLS,
    ),
)
def text_filter(spark, sf_dir):
    kept = P.text_filter(variants(spark, sf_dir, CALLS), ["ZIGOSITY HOM", "EFFECT intron|up.*gene"])
    return plain(kept, "SAMPLE", *KEY_NAMES, "ZIGOSITY", "EFFECT")


@query("text_filter_empty", check_sql(f"SELECT sample, {ID}, rsid FROM t WHERE rsid IS NOT NULL", t=TRIO))
def text_filter_empty(spark, sf_dir):
    return plain(P.text_filter(variants(spark, sf_dir, TRIO), ["RSID Empty"]), "SAMPLE", *KEY_NAMES, "RSID")


def by_chrom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls as a table partitioned by chromosome."""
    path = scratch_path(spark, "by-chrom")
    K.write_flat_parquet(variants(spark, sf_dir, CALLS), path, ["CHROM"])
    return spark.read.parquet(path)


@query("chromosome_slice", check_sql(f"SELECT sample, {ID}, zigosity FROM c WHERE chrom = 'chr7'", c=CALLS))
def chromosome_slice(spark, sf_dir):
    return plain(P.chromosome_slice(by_chrom(spark, sf_dir), "chr7"), "SAMPLE", *KEY_NAMES, "ZIGOSITY")


@query("point_lookup", check_sql(f"SELECT sample, {ID}, zigosity FROM c WHERE chrom = 'chr8' AND pos = 1000 + 29 * 37", c=CALLS))
def point_lookup(spark, sf_dir):
    return plain(P.point_lookup(by_chrom(spark, sf_dir), "chr8", 1000 + 29 * 37), "SAMPLE", *KEY_NAMES, "ZIGOSITY")


@query(
    "typed_partition_range",
    """SELECT CAST(l_orderkey AS BIGINT) AS id, l_quantity AS value, CAST(l_linenumber AS INTEGER) AS part,
  CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS VARCHAR) AS day FROM lineitem
  WHERE CAST(date_trunc('quarter', l_shipdate) AS DATE) > DATE '1996-01-01'
    AND CAST(date_trunc('quarter', l_shipdate) AS DATE) < DATE '2000-12-12'""",
)
def typed_partition_range(spark, sf_dir):
    path = scratch_path(spark, "typed")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.select(
        F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("value"), F.col("l_linenumber").alias("part"),
        F.trunc("l_shipdate", "quarter").alias("day"),
    ).hint("rebalance", F.col("day"), F.col("part")).write.partitionBy("day", "part").csv(path, header=True)
    table = T.read_partitioned_csv(
        spark, path, {"part": "int", "day": "date", "id": "bigint", "value": "double"}, "day", "1996-01-01", "2000-12-12"
    )
    return table.withColumn("day", F.col("day").cast("string"))


@query(
    "normalize_sample",
    """SELECT c_custkey, SPLIT_PART(name, '_proc', 1) AS sample_base, LOWER(REPLACE(name, '-', '_')) AS table_safe
  FROM (SELECT c_custkey, CONCAT('P-', CAST(c_custkey AS VARCHAR), CASE WHEN c_nationkey % 2 = 0 THEN '_proc' ELSE '' END, '-X') AS name
  FROM customer) x""",
)
def normalize_sample(spark, sf_dir):
    names = relation(
        spark, sf_dir,
        """SELECT c_custkey, CONCAT('P-', CAST(c_custkey AS STRING), CASE WHEN c_nationkey % 2 = 0 THEN '_proc' ELSE '' END, '-X') AS name
  FROM {customer}""",
    )
    name = F.col("name")
    return names.select("c_custkey", L.sample_base(name, "_proc").alias("sample_base"), L.table_safe(name).alias("table_safe"))


# ---- comparing samples -----------------------------------------------------------

def label(names: list[str]) -> str:
    parts = ", ".join(f"MAX(CASE WHEN sample = '{n}' THEN '{n}' END)" for n in names)
    return f"CONCAT_WS(':', {parts})"


VENN_SQL = f"SELECT {ID}, {label(TRIO_NAMES)} AS venn FROM t GROUP BY {ID}"


def trio_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.membership(variants(spark, sf_dir, TRIO), TRIO_NAMES)


@query("trios_membership", check_sql(VENN_SQL, t=TRIO))
def trios_membership(spark, sf_dir):
    return plain(trio_membership(spark, sf_dir), *KEY_NAMES, "VENN")


REGIONS = ", ".join(f"({i}, '{':'.join(r)}')" for i, r in enumerate(V.regions(TRIO_NAMES)))


@query(
    "venn_counts",
    check_sql(
        f"""SELECT CAST(region_order AS INTEGER) AS region_order, r.venn, COUNT(v.venn) AS variants
  FROM (VALUES {REGIONS}) r(region_order, venn) LEFT JOIN ({VENN_SQL}) v ON r.venn = v.venn GROUP BY 1, 2""",
        t=TRIO,
    ),
)
def venn_counts(spark, sf_dir):
    return plain(V.venn_counts(trio_membership(spark, sf_dir), TRIO_NAMES))


# Samples of a line number and a return flag, variants of an order: 21 samples, many regions.
MANY = f"""SELECT DISTINCT CONCAT('P', CAST(l_linenumber AS STRING), l_returnflag) AS sample, CONCAT('chr', CAST(l_orderkey % 22 + 1 AS STRING)) AS chrom,
  1000 + l_orderkey * 37 AS pos, {base('l_orderkey')} AS ref, {base('l_orderkey + 1')} AS alt FROM {{lineitem}}"""
MANY_NAMES = [f"P{i}{flag}" for i in range(1, 8) for flag in "ANR"]
MANY_REGIONS = f"SELECT {ID}, STRING_AGG(sample, ':' ORDER BY sample) AS venn FROM m GROUP BY {ID}"


@query("many_sample_regions", check_sql(f"SELECT venn, COUNT(*) AS variants FROM ({MANY_REGIONS}) v GROUP BY venn", m=MANY))
def many_sample_regions(spark, sf_dir):
    """Variants in exactly the samples of each region that occurs, among 21 samples."""
    counts = V.mask_counts(V.presence_masks(variants(spark, sf_dir, MANY), MANY_NAMES))
    return counts.select(V.region_of(F.col("MASK"), MANY_NAMES).alias("venn"), "variants")


@query(
    "shared_at_least",
    check_sql(
        f"""SELECT sample AS venn, COUNT(*) AS variants FROM m GROUP BY sample
  UNION ALL SELECT a.sample || ':' || b.sample, COUNT(*) FROM m a JOIN m b USING ({ID}) WHERE a.sample < b.sample GROUP BY 1""",
        m=MANY,
    ),
)
def shared_at_least(spark, sf_dir):
    """Variants that each sample, and each two samples, hold at least."""
    counts = V.mask_counts(V.presence_masks(variants(spark, sf_dir, MANY), MANY_NAMES))
    shared = V.at_least_counts(counts, len(MANY_NAMES), 2)
    return shared.select(V.region_of(F.col("MASK"), MANY_NAMES).alias("venn"), "variants")


@query("venn_place", check_sql(f"SELECT * FROM ({VENN_SQL}) v WHERE venn = 'TEST:TEST3'", t=TRIO))
def venn_place(spark, sf_dir):
    return plain(V.venn_place(trio_membership(spark, sf_dir), "A:C", TRIO_NAMES), *KEY_NAMES, "VENN")


def compare_sql(names: list[str]) -> str:
    """The merged table: same genes are one column, other call columns one per sample."""
    def of(name: str, column: str) -> str:
        return f"MAX(CASE WHEN sample = '{name}' THEN {column} END)"

    per = ", ".join(f"{of(n, c)} AS {c}_{n.lower()}" for c in ("zigosity", "effect", "impact") for n in names)
    first = " ".join(f"WHEN MAX(CASE WHEN sample = '{n}' THEN 1 END) = 1 THEN {of(n, 'rsid')}" for n in names)
    return (
        f"SELECT {ID}, {label(names)} AS venn, {per}, MIN(gene_name) AS gene_name, MIN(vartype) AS vartype,"
        f" CASE {first} END AS rsid FROM t GROUP BY {ID}"
    )


def stored_tables(spark: SparkSession, sf_dir: str, text: str, names: list[str]) -> dict[str, DataFrame]:
    """One table per sample, read from storage as samples are."""
    return J.sample_tables(written(variants(spark, sf_dir, text), "samples"), names)


@query("duos", check_sql(compare_sql(DUO_NAMES), t=DUO))
def duos(spark, sf_dir):
    return plain(V.compare_samples(stored_tables(spark, sf_dir, DUO, DUO_NAMES)).drop("samples"))


@query("trios", check_sql(compare_sql(TRIO_NAMES), t=TRIO))
def trios(spark, sf_dir):
    return plain(V.compare_samples(stored_tables(spark, sf_dir, TRIO, TRIO_NAMES)).drop("samples"))


@query("trios_lazy", check_sql(compare_sql(TRIO_NAMES), t=TRIO))
def trios_lazy(spark, sf_dir):
    """The same from one long table, with the per-sample columns named by the caller: no extra job."""
    merged = V.compare_long(variants(spark, sf_dir, TRIO), TRIO_NAMES, ["ZIGOSITY", "EFFECT", "IMPACT"])
    return plain(merged.drop("samples"))


GENES = [f"GENE{i}" for i in (1, 7, 12, 30, 44)]
GENES_SQL = ", ".join(f"'{g}'" for g in GENES)


def gene_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = variants(spark, sf_dir, TRIO).select(F.col("GENE_NAME").alias("GeneSymbol")).distinct()
    return genes.filter(F.col("GeneSymbol").isin(GENES))


@query(
    "duos_job",
    check_sql(
        f"""SELECT {ID}, venn, gene_name, vartype, rsid, zigosity_test, effect_test FROM ({compare_sql(DUO_NAMES)}) x
  WHERE venn = 'TEST' AND gene_name IN ({GENES_SQL}) AND NOT regexp_matches(COALESCE(zigosity_test, '.'), 'HOM')""",
        t=DUO,
    ),
)
def duos_job(spark, sf_dir):
    """Two samples: region A, panel, drop homozygous."""
    tables = stored_tables(spark, sf_dir, DUO, DUO_NAMES)
    out = J.compare(tables, "A", gene_panel(spark, sf_dir), ["ZIGOSITY_TEST HOM"])
    return plain(out, *KEY_NAMES, "VENN", "GENE_NAME", "VARTYPE", "RSID", "ZIGOSITY_TEST", "EFFECT_TEST")


@query(
    "trios_job",
    check_sql(
        f"""SELECT {ID}, venn, gene_name, vartype, rsid, zigosity_test3 FROM ({compare_sql(TRIO_NAMES)}) x
  WHERE venn = 'TEST:TEST2:TEST3' AND gene_name IN ({GENES_SQL}) AND NOT regexp_matches(vartype, 'SNP')""",
        t=TRIO,
    ),
)
def trios_job(spark, sf_dir):
    """Three samples: shared by all, panel, drop SNPs."""
    tables = stored_tables(spark, sf_dir, TRIO, TRIO_NAMES)
    out = J.compare(tables, "A:B:C", gene_panel(spark, sf_dir), ["VARTYPE SNP"])
    return plain(out, *KEY_NAMES, "VENN", "GENE_NAME", "VARTYPE", "RSID", "ZIGOSITY_TEST3")


@query(
    "shared_variants",
    check_sql(f"SELECT {ID}, zigosity FROM t a WHERE sample = 'TEST' AND EXISTS (SELECT 1 FROM t b WHERE b.sample = 'TEST2' AND a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt)", t=DUO),
)
def shared_variants(spark, sf_dir):
    t = J.sample_tables(variants(spark, sf_dir, DUO), DUO_NAMES)
    return plain(V.shared_variants(t["TEST"], t["TEST2"]), *KEY_NAMES, "ZIGOSITY")


@query(
    "own_variants",
    check_sql(f"SELECT {ID}, zigosity FROM t a WHERE sample = 'TEST' AND NOT EXISTS (SELECT 1 FROM t b WHERE b.sample = 'TEST2' AND a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt)", t=DUO),
)
def own_variants(spark, sf_dir):
    t = J.sample_tables(variants(spark, sf_dir, DUO), DUO_NAMES)
    return plain(V.own_variants(t["TEST"], t["TEST2"]), *KEY_NAMES, "ZIGOSITY")


# ---- cohort ----------------------------------------------------------------------

PER_SAMPLE = f"""per_sample AS (SELECT {ID}, sample,
  MAX(CASE zigosity WHEN 'HOM' THEN 2 WHEN 'HET' THEN 1 ELSE 0 END) AS dosage FROM c GROUP BY {ID}, sample)"""
N_SAMPLES = "(SELECT COUNT(DISTINCT sample) FROM c)"
FREQ = f"""freqs AS (SELECT {ID}, COUNT(*) AS n_carriers, CAST(SUM(dosage) AS BIGINT) AS n_alleles,
  ROUND(CAST(COUNT(*) AS DOUBLE) / CAST({N_SAMPLES} AS DOUBLE), 6) AS freq,
  ROUND(CAST(SUM(dosage) AS DOUBLE) / (2 * CAST({N_SAMPLES} AS DOUBLE)), 6) AS allele_freq
  FROM per_sample GROUP BY {ID})"""


def cohort_sql(calls: str, body: str, **more: str) -> str:
    head = check_sql("", c=calls, **more).strip()
    return f"{head}, {PER_SAMPLE}, {FREQ} {body}"


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"FREQ": F.round("FREQ", 6), "ALLELE_FREQ": F.round("ALLELE_FREQ", 6)})


@query("carrier_freq", cohort_sql(ROWS, f"SELECT {ID}, n_carriers, freq FROM freqs"))
def carrier_freq(spark, sf_dir):
    """From rows that repeat a sample's variant."""
    return plain(rounded(C.cohort_frequencies(variants(spark, sf_dir, ROWS))), *KEY_NAMES, "N_CARRIERS", "FREQ")


@query("allele_freq", cohort_sql(CALLS, f"SELECT {ID}, n_alleles, allele_freq FROM freqs"))
def allele_freq(spark, sf_dir):
    """From unique calls: one shuffle."""
    freqs = C.cohort_frequencies(variants(spark, sf_dir, CALLS), unique=True)
    return plain(rounded(freqs), *KEY_NAMES, "N_ALLELES", "ALLELE_FREQ")


LABELS = ", ".join(f"STRING_AGG(DISTINCT {c}, ' | ' ORDER BY {c}) AS {c}" for c in ("gene_name", "hgvs_c", "hgvs_p"))


@query("cohort_labels", check_sql(f"SELECT {ID}, {LABELS} FROM c GROUP BY {ID}", c=ROWS))
def cohort_labels(spark, sf_dir):
    return plain(C.cohort_labels(variants(spark, sf_dir, ROWS)))


@query("cohort_table", cohort_sql(ROWS, f"SELECT l.*, freq, allele_freq FROM (SELECT {ID}, {LABELS} FROM c GROUP BY {ID}) l JOIN freqs USING ({ID})"))
def cohort_table(spark, sf_dir):
    return plain(rounded(C.cohort_table(variants(spark, sf_dir, ROWS))).drop("N_CARRIERS", "N_ALLELES"))


@query(
    "merge_frequencies",
    cohort_sql(ROWS, f"SELECT {ID}, n_carriers, n_alleles, freq, allele_freq FROM freqs"),
)
def merge_frequencies(spark, sf_dir):
    """Sums of two batches of samples, added up, equal the sums over the whole cohort."""
    calls = variants(spark, sf_dir, ROWS)
    batches = [C.carrier_stats(calls.filter("SAMPLE < 'S5'")), C.carrier_stats(calls.filter("SAMPLE >= 'S5'"))]
    return plain(rounded(C.with_frequencies(C.merge_stats(*batches), C.sample_count(calls))))


LINE_CALLS = f"""SELECT CONCAT('L', CAST(l_linenumber AS STRING)) AS sample,
  CONCAT('chr', CAST(l_orderkey % 22 + 1 AS STRING)) AS chrom, 1000 + l_orderkey * 37 AS pos,
  {base('l_orderkey')} AS ref, {base('l_orderkey + 1')} AS alt,
  CASE MAX(l_returnflag) WHEN 'R' THEN 'HOM' WHEN 'N' THEN 'HET' ELSE 'UNKWN' END AS zigosity
FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5"""
LINE_SAMPLES = [f"L{i}" for i in range(1, 8)]
MATRIX_SQL = f"""SELECT {ID},
  ROUND(CAST(SUM(CASE zigosity WHEN 'HOM' THEN 2 WHEN 'HET' THEN 1 ELSE 0 END) AS DOUBLE) / 14, 6) AS allele_freq,
  ROUND(CAST(COUNT(*) AS DOUBLE) / 7, 6) AS freq,
  {', '.join(f"COALESCE(MAX(CASE WHEN sample = '{s}' THEN zigosity END), '.') AS {s.lower()}" for s in LINE_SAMPLES)}
  FROM c GROUP BY {ID}"""


@query("cohort_matrix", check_sql(MATRIX_SQL, c=LINE_CALLS))
def cohort_matrix(spark, sf_dir):
    return plain(rounded(C.cohort_matrix(variants(spark, sf_dir, LINE_CALLS), LINE_SAMPLES)))


@query("matrix_to_calls", check_sql(f"SELECT sample, {ID}, zigosity FROM c", c=LINE_CALLS))
def matrix_to_calls(spark, sf_dir):
    """A wide cohort taken apart again."""
    matrix = written(C.cohort_matrix(variants(spark, sf_dir, LINE_CALLS), LINE_SAMPLES), "matrix")
    return plain(C.matrix_to_calls(matrix, LINE_SAMPLES))


# Every part as a report row; some variants are unknown to the cohort.
REPORT = f"""SELECT CONCAT('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chrom, 1000 + p_partkey * 37 AS pos,
  {base('p_partkey')} AS ref, {base('p_partkey + p_size')} AS alt, p_brand AS gene_name, p_type AS feature_id
FROM {{part}}"""


@query(
    "annotate_frequencies",
    cohort_sql(ROWS, f"SELECT r.*, freq AS vardb_freq, allele_freq FROM r LEFT JOIN freqs USING ({ID})", r=REPORT),
)
def annotate_frequencies(spark, sf_dir):
    freqs = C.cohort_frequencies(variants(spark, sf_dir, ROWS))
    return plain(C.annotate_frequencies(variants(spark, sf_dir, REPORT), freqs))


CARRIER_SQL = f"""SELECT {ID}, COALESCE(STRING_AGG(DISTINCT sample, ',' ORDER BY sample), '') AS carriers
  FROM r LEFT JOIN c USING ({ID}) GROUP BY {ID}"""


@query("carriers", check_sql(CARRIER_SQL, c=ROWS, r=REPORT))
def carriers(spark, sf_dir):
    found = C.carriers(variants(spark, sf_dir, REPORT), variants(spark, sf_dir, ROWS))
    return plain(
        found.withColumn("CARRIERS", F.array_join("PATS_WITH_VARIANTS", ",")).drop("PATS_WITH_VARIANTS")
    )


@query(
    "single_job",
    cohort_sql(
        CALLS,
        f"""SELECT r.*, freq AS vardb_freq, allele_freq, carriers FROM r LEFT JOIN freqs USING ({ID})
  LEFT JOIN ({CARRIER_SQL}) k USING ({ID}) WHERE r.gene_name IN ({PANEL_SQL})""",
        r=REPORT,
    ),
)
def single_job(spark, sf_dir):
    """Panel filter, cohort frequencies and carriers of one report."""
    out = J.single(
        variants(spark, sf_dir, REPORT), panel(spark, sf_dir), variants(spark, sf_dir, CALLS), with_carriers=True
    )
    return plain(out.withColumn("CARRIERS", F.array_join("PATS_WITH_VARIANTS", ",")).drop("PATS_WITH_VARIANTS"))


@query(
    "write_read_cohort",
    check_sql(f"SELECT sample, {ID}, zigosity, gene_name, hgvs_c, hgvs_p FROM c", c=CALLS),
)
def write_read_cohort(spark, sf_dir):
    """The long cohort partitioned by sample, written twice: the second write replaces the first."""
    path = scratch_path(spark, "cohort")
    calls = C.to_calls(variants(spark, sf_dir, CALLS))
    K.write_cohort(calls, path)
    K.write_cohort(calls, path)
    return plain(T.read_cohort_parquet(spark, path))


COHORT_CSV = f"SELECT {ID}, {LABELS}, freq, allele_freq FROM c JOIN freqs USING ({ID}) GROUP BY {ID}, freq, allele_freq"


@query(
    "cohort_csv_by_chrom",
    cohort_sql(ROWS, f"SELECT {ID}, gene_name, hgvs_c, hgvs_p, ROUND(freq, 5) AS freq, ROUND(allele_freq, 5) AS allele_freq FROM ({COHORT_CSV}) x").replace(", 6)", ", 12)"),
)
def cohort_csv_by_chrom(spark, sf_dir):
    """Sorted CSVs per chromosome with 5-place fractions, read back with a column subset."""
    path = scratch_path(spark, "cohort-csv")
    K.write_cohort_by_chrom(C.cohort_table(variants(spark, sf_dir, ROWS)), path)
    back = T.read_cohort_csv(spark, path, [*KEY, "GENE_NAME", "HGVS.C", "HGVS.P", "FREQ", "ALLELE_FREQ"])
    return plain(back)


@query(
    "select_sample_files",
    """SELECT path, sample FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY stem ORDER BY processed DESC, path) AS n
  FROM (SELECT CONCAT('/data/', CAST(o_custkey AS VARCHAR), '/', CAST(o_orderkey AS VARCHAR), '/P', CAST(o_custkey AS VARCHAR),
      CASE WHEN o_orderkey % 3 = 0 THEN '_proc' ELSE '' END, '.final.vcf') AS path,
    CONCAT('P', CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 3 = 0 THEN '_proc' ELSE '' END) AS sample,
    CONCAT('P', CAST(o_custkey AS VARCHAR)) AS stem, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS processed
    FROM orders WHERE o_orderstatus <> 'F') x) y
  WHERE n = 1 AND stem NOT IN (SELECT CONCAT('P', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def select_sample_files(spark, sf_dir):
    """One file per customer from paths of all orders; finished orders are not sample files."""
    paths = relation(
        spark, sf_dir,
        """SELECT CONCAT('/data/', CAST(o_custkey AS STRING), '/', CAST(o_orderkey AS STRING), '/P', CAST(o_custkey AS STRING),
    CASE WHEN o_orderkey % 3 = 0 THEN '_proc' ELSE '' END, CASE WHEN o_orderstatus = 'F' THEN '.raw.vcf' ELSE '.final.vcf' END) AS path
  FROM {orders}""",
    )
    known = relation(
        spark, sf_dir,
        """SELECT CONCAT('P', CAST(c_custkey AS STRING), CASE WHEN c_nationkey % 2 = 0 THEN '_proc' ELSE '' END) AS SAMPLE
  FROM {customer} WHERE c_mktsegment = 'MACHINERY'""",
    )
    return plain(FS.select_sample_files(paths, "_proc", known))


# ---- statistics and differences --------------------------------------------------

GENERAL_SQL = "SELECT chrom, zigosity, vartype, impact, effect, COUNT(*) AS n FROM c GROUP BY ALL"


@query("general_stats", check_sql(GENERAL_SQL, c=CALLS))
def general_stats(spark, sf_dir):
    return plain(S.general_stats(variants(spark, sf_dir, CALLS)))


@query("stats_by_chrom", check_sql(f"SELECT chrom, COUNT(*) AS groups, CAST(SUM(n) AS BIGINT) AS variants FROM ({GENERAL_SQL}) x GROUP BY chrom", c=CALLS))
def stats_by_chrom(spark, sf_dir):
    return plain(S.stats_by_chrom(S.general_stats(variants(spark, sf_dir, CALLS))))


@query(
    "annotation_multiplicity",
    check_sql(
        f"""SELECT COUNT(*) AS variants, CAST(SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS single,
  CAST(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multiple FROM (SELECT {ID}, COUNT(*) AS n FROM c GROUP BY {ID}) x""",
        c=ROWS,
    ),
)
def annotation_multiplicity(spark, sf_dir):
    return S.annotation_multiplicity(variants(spark, sf_dir, ROWS))


DIFF_SQL = """SELECT COALESCE(a.chrom, b.chrom) AS chrom, COALESCE(a.pos, b.pos) AS pos, COALESCE(a.ref, b.ref) AS ref,
  COALESCE(a.alt, b.alt) AS alt, COALESCE(a.rsid, b.rsid) AS rsid, COALESCE(a.n, 0) AS n_left, COALESCE(b.n, 0) AS n_right,
  CASE WHEN b.n IS NULL THEN 'left_only' WHEN a.n IS NULL THEN 'right_only' ELSE 'both' END AS side
  FROM (SELECT chrom, pos, ref, alt, rsid, COUNT(*) AS n FROM t WHERE sample = 'TEST' GROUP BY ALL) a
  FULL JOIN (SELECT chrom, pos, ref, alt, rsid, COUNT(*) AS n FROM t WHERE sample = 'TEST2' GROUP BY ALL) b
  ON a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt AND a.rsid IS NOT DISTINCT FROM b.rsid"""


def duo_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = J.sample_tables(variants(spark, sf_dir, DUO), DUO_NAMES)
    return S.dataset_diff(t["TEST"].select(*KEY, "RSID"), t["TEST2"].select("RSID", *KEY, "EFFECT"))


@query("dataset_diff", check_sql(DIFF_SQL, t=DUO))
def dataset_diff(spark, sf_dir):
    return plain(duo_diff(spark, sf_dir))


@query(
    "diff_counts",
    check_sql(f"SELECT side, CAST(SUM(GREATEST(n_left, 1) * GREATEST(n_right, 1)) AS BIGINT) AS rows FROM ({DIFF_SQL}) d GROUP BY side", t=DUO),
)
def diff_counts(spark, sf_dir):
    return plain(S.diff_counts(duo_diff(spark, sf_dir)))


@query(
    "schema_diff",
    """SELECT 'O_ORDERKEY' AS name, 'left_only' AS side, (SELECT COUNT(o_orderkey) FROM orders) AS left_filled, CAST(NULL AS BIGINT) AS right_filled
  UNION ALL SELECT 'O_ORDERDATE', 'both', (SELECT COUNT(o_orderdate) FROM orders), (SELECT COUNT(l_shipdate) FROM lineitem)
  UNION ALL SELECT 'O_TOTALPRICE', 'both', (SELECT COUNT(o_totalprice) FROM orders), (SELECT COUNT(l_extendedprice) FROM lineitem)
  UNION ALL SELECT 'L_TAX', 'right_only', NULL, (SELECT COUNT(l_tax) FROM lineitem)""",
)
def schema_diff(spark, sf_dir):
    left = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice")
    right = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_shipdate AS O_ORDERDATE", "l_extendedprice AS O_TotalPrice", "l_tax"
    )
    return S.schema_diff(left, right)


def profile_sql(table: str, numbers: dict[str, str], texts: dict[str, str]) -> str:
    rows = []
    for c, kind in numbers.items():
        v = f"CAST({c} AS DOUBLE)"
        rows.append(
            f"""SELECT '{c}' AS name, '{kind}' AS type, COUNT(*) AS rows, COUNT({c}) AS filled, ROUND(AVG({v}), 4) AS mean,
  ROUND(STDDEV_SAMP({v}), 4) AS std, MIN({v}) + 0.0 AS lowest, MAX({v}) AS highest, QUANTILE_CONT({v}, 0.25) AS p25,
  QUANTILE_CONT({v}, 0.5) AS p50, QUANTILE_CONT({v}, 0.75) AS p75 FROM {table}"""
        )
    for c, kind in texts.items():
        nulls = ", ".join(["CAST(NULL AS DOUBLE)"] * 7)
        rows.append(f"SELECT '{c}', '{kind}', COUNT(*), COUNT({c}), {nulls} FROM {table}")
    return " UNION ALL ".join(rows)


PROFILED = {"l_partkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double"}


@query("profile", profile_sql("lineitem", PROFILED, {"l_returnflag": "string", "l_shipdate": "timestamp_ntz"}))
def profile(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*PROFILED, "l_returnflag", "l_shipdate")
    out = S.profile(table)
    return plain(out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)}))


@query("list_samples", check_sql("SELECT DISTINCT sample FROM c", c=ROWS))
def list_samples(spark, sf_dir):
    return plain(S.list_values(variants(spark, sf_dir, ROWS), "SAMPLE"))


@query("list_chromosomes", check_sql("SELECT DISTINCT chrom FROM c", c=ROWS))
def list_chromosomes(spark, sf_dir):
    return plain(S.list_values(variants(spark, sf_dir, ROWS), "CHROM"))


@query(
    "union_by_name",
    check_sql(f"SELECT sample, {ID}, zigosity, rsid, feature_id FROM c UNION ALL BY NAME SELECT sample, {ID}, zigosity, effect FROM t", c=CALLS, t=TRIO),
)
def union_by_name(spark, sf_dir):
    calls = variants(spark, sf_dir, CALLS).select("SAMPLE", *KEY, "ZIGOSITY", "RSID", "FEATURE_ID")
    trio = variants(spark, sf_dir, TRIO).select("EFFECT", "ZIGOSITY", *KEY, "SAMPLE")
    return plain(T.union_by_name(calls, trio))


@query("first_variants", check_sql(f"SELECT sample, {ID}, zigosity FROM c ORDER BY chrom, pos, ref, alt, sample LIMIT 10", c=CALLS))
def first_variants(spark, sf_dir):
    ordered = variants(spark, sf_dir, CALLS).orderBy(*KEY, "SAMPLE")
    return plain(ordered.limit(10), "SAMPLE", *KEY_NAMES, "ZIGOSITY")


@query("sort_variants", check_sql(f"SELECT {ID}, sample FROM c", c=CALLS))
def sort_variants(spark, sf_dir):
    return plain(R.sort_variants(variants(spark, sf_dir, CALLS)), *KEY_NAMES, "SAMPLE")


# ---- intervals -------------------------------------------------------------------

STEPS = """steps AS (SELECT chrom, pos, SUM(step) AS step, MAX(edge) AS edge FROM (
  SELECT chrom, start_pos AS pos, 1 AS step, 0 AS edge FROM reads WHERE start_pos < end_pos
  UNION ALL SELECT chrom, end_pos, -1, 0 FROM reads WHERE start_pos < end_pos {ends}) x
  GROUP BY chrom, pos HAVING SUM(step) <> 0 OR MAX(edge) = 1)"""
RUNS = """runs AS (SELECT * FROM (SELECT chrom, pos AS start_pos, LEAD(pos) OVER w AS end_pos,
  CAST(SUM(step) OVER w AS BIGINT) AS depth FROM steps WINDOW w AS (PARTITION BY chrom ORDER BY pos)) x WHERE end_pos IS NOT NULL)"""
ENDS = "UNION ALL SELECT chrom, 0, 0, 1 FROM lengths UNION ALL SELECT chrom, length, 0, 1 FROM lengths"


def depth_sql(body: str, ends: str = "", **more: str) -> str:
    head = check_sql("", reads=READS, **more).strip()
    return f"{head}, {STEPS.format(ends=ends)}, {RUNS} {body}"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, sf_dir, READS)


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, sf_dir, EXONS)


@query("depth_runs", depth_sql("SELECT chrom, start_pos, end_pos, depth FROM runs"))
def depth_runs(spark, sf_dir):
    return plain(I.depth_runs(reads(spark, sf_dir), bin_width=1 << 12))


@query("depth_runs_with_ends", depth_sql("SELECT chrom, start_pos, end_pos, depth FROM runs", ENDS, lengths=LENGTHS))
def depth_runs_with_ends(spark, sf_dir):
    lengths = variants(spark, sf_dir, LENGTHS)
    return plain(I.depth_runs(reads(spark, sf_dir), lengths, bin_width=1 << 12))


OVERLAP = """FROM {a} a JOIN exons b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos"""
CLIP = "a.chrom, GREATEST(a.start_pos, b.start_pos) AS start_pos, LEAST(a.end_pos, b.end_pos) AS end_pos"


@query("interval_intersect", check_sql(f"SELECT {CLIP} {OVERLAP.format(a='reads')}", reads=READS, exons=EXONS))
def interval_intersect(spark, sf_dir):
    return plain(I.interval_intersect(reads(spark, sf_dir), exons(spark, sf_dir), bin_width=1 << 10))


@query("interval_intersect_shuffled", check_sql(f"SELECT {CLIP} {OVERLAP.format(a='reads')}", reads=READS, exons=EXONS))
def interval_intersect_shuffled(spark, sf_dir):
    """The way taken when the gene side is too large to broadcast."""
    return plain(
        I.interval_intersect(reads(spark, sf_dir), exons(spark, sf_dir), bin_width=1 << 10, max_broadcast_rows=0)
    )


COVER = f"cover AS (SELECT {CLIP}, a.depth, b.gene_exon AS exon, SPLIT_PART(b.gene_exon, '_', 1) AS gene {OVERLAP.format(a='runs')})"


def cover_sql(body: str) -> str:
    return depth_sql("", exons=EXONS).strip() + f", {COVER} {body}"


@query("annotate_genes", cover_sql("SELECT chrom, start_pos, end_pos, depth, exon FROM cover"))
def annotate_genes(spark, sf_dir):
    return plain(J.coverage(reads(spark, sf_dir), exons(spark, sf_dir), bin_width=1 << 10))


@query(
    "uncovered_exons",
    depth_sql("", ENDS, lengths=WIDE_LENGTHS, exons=WIDE_EXONS).strip() + f", {COVER} SELECT chrom, start_pos, end_pos, depth, exon FROM cover",
)
def uncovered_exons(spark, sf_dir):
    """Exons by depth, also on chromosomes that are one zero run of 100 Mb."""
    lengths, genes = variants(spark, sf_dir, WIDE_LENGTHS), variants(spark, sf_dir, WIDE_EXONS)
    return plain(J.coverage(reads(spark, sf_dir), genes, lengths=lengths))


def summary_sql(level: str) -> str:
    return cover_sql(
        f"""SELECT {level}, chrom, ROUND(AVG(depth), 6) AS mean, ROUND(STDDEV_SAMP(depth), 6) AS std, MIN(depth) AS lowest,
  QUANTILE_CONT(depth, 0.25) AS p25, QUANTILE_CONT(depth, 0.5) AS p50, QUANTILE_CONT(depth, 0.75) AS p75, MAX(depth) AS highest
  FROM cover GROUP BY {level}, chrom"""
    )


def summary(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    table = J.coverage_summary(reads(spark, sf_dir), exons(spark, sf_dir), level, bin_width=1 << 10)
    return plain(table.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)}))


@query("depth_summary_gene", summary_sql("gene"))
def depth_summary_gene(spark, sf_dir):
    return summary(spark, sf_dir, "GENE")


@query("depth_summary_exon", summary_sql("exon"))
def depth_summary_exon(spark, sf_dir):
    return summary(spark, sf_dir, "EXON")


@query("depth_summary_spread", summary_sql("gene"))
def depth_summary_spread(spark, sf_dir):
    """The same with quartiles found over ranges of depths."""
    cover = J.coverage(reads(spark, sf_dir), exons(spark, sf_dir), bin_width=1 << 10)
    table = I.depth_summary(cover, "GENE", spread=True)
    return plain(table.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)}))


@query(
    "write_depth_reports",
    cover_sql("SELECT gene, chrom, ROUND(AVG(depth), 6) AS mean, MIN(depth) AS lowest, MAX(depth) AS highest FROM cover GROUP BY gene, chrom"),
)
def write_depth_reports(spark, sf_dir):
    return depth_report(spark, sf_dir, "GENE")


@query(
    "write_depth_reports_exon",
    cover_sql("SELECT exon, chrom, ROUND(AVG(depth), 6) AS mean, MIN(depth) AS lowest, MAX(depth) AS highest FROM cover GROUP BY exon, chrom"),
)
def write_depth_reports_exon(spark, sf_dir):
    return depth_report(spark, sf_dir, "EXON")


def depth_report(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """Depth track written and read as headerless text, then both summaries as CSV; one of them is returned."""
    track, out = scratch_path(spark, "track"), scratch_path(spark, "depth-report")
    J.coverage(reads(spark, sf_dir), exons(spark, sf_dir), bin_width=1 << 10).write.csv(track, sep="\t")
    K.write_depth_reports(T.read_depth(spark, track), out)
    back = spark.read.csv(f"{out}/coverage_per_{level.lower()}", header=True)
    return back.select(
        F.col(level).alias(level.lower()), F.col("CHROM").alias("chrom"), F.round(F.col("mean").cast("double"), 6).alias("mean"),
        F.col("min").cast("bigint").alias("lowest"), F.col("max").cast("bigint").alias("highest"),
    )


@query("read_bed", check_sql("SELECT chrom, start_pos, end_pos, gene_exon, '+' AS strand FROM exons", exons=EXONS))
def read_bed(spark, sf_dir):
    path = scratch_path(spark, "bed")
    exons(spark, sf_dir).withColumn("STRAND", F.lit("+")).write.csv(path, sep="\t")
    return plain(T.read_bed(spark, path))


# ---- reports and checks ----------------------------------------------------------

@query(
    "link_columns",
    check_sql(
        f"""SELECT sample, {ID}, rsid AS rsid_shown, 'https://varsome.com/variant/hg19/' || rsid AS rsid_url,
  'https://www.ncbi.nlm.nih.gov/omim/?term=' || gene_name AS gene_url FROM c""",
        c=CALLS,
    ),
)
def link_columns(spark, sf_dir):
    calls = variants(spark, sf_dir, CALLS).withColumn("RSID", F.concat(F.lit("COSM1,x;"), "RSID", F.lit(",rs1")))
    return plain(R.link_columns(calls), "SAMPLE", *KEY_NAMES, "RSID_SHOWN", "RSID_URL", "GENE_URL")


def sheet(order: list[str]) -> str:
    have = ["gene_name", "hgvs_p", "hgvs_c", "rsid", "impact", "effect", "feature_id", "zigosity", "chrom", "pos", "ref", "alt", "vartype", "qual"]
    wanted = {c.lower().replace(".", "_") for c in order}
    return ", ".join(c for c in have if c in wanted)


@query("report_projection", check_sql(f"SELECT {sheet(REPORT_COLUMNS)} FROM c", c=CALLS))
def report_projection(spark, sf_dir):
    return plain(R.sort_report(R.report_projection(variants(spark, sf_dir, CALLS))))


@query("vendor_projection", check_sql(f"SELECT {sheet(VENDOR_COLUMNS)} FROM c", c=CALLS))
def vendor_projection(spark, sf_dir):
    return plain(R.vendor_projection(R.sort_vendor(variants(spark, sf_dir, CALLS))))


ORDERS = {
    "variants": (R.sort_variants, "struct(CHROM, POS)"),
    "report": (R.sort_report, "struct(SAMPLE, CHROM, POS, REF, ALT)"),
    "vendor": (
        R.sort_vendor,
        "struct(CASE CHROM WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrUn_7' THEN 25 ELSE CAST(SUBSTRING(CHROM, 4) AS INT) END AS place, POS)",
    ),
}


def inversions(table: DataFrame, path: str, key: str) -> DataFrame:
    """n and inversions: rows of a written table below the row before them, in their file or the one before."""
    table.write.parquet(path)
    back = table.sparkSession.read.parquet(path).selectExpr("_metadata.file_name AS file", "_metadata.row_index AS place", f"{key} AS key")
    before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    files = back.withColumn("bad", F.coalesce((F.col("key") < before).cast("bigint"), F.lit(0))).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    # One row per file.
    gap = F.coalesce((F.col("first") < F.lag("last").over(Window.orderBy("file"))).cast("bigint"), F.lit(0))
    return files.withColumn("gap", gap).agg(F.sum("n").alias("n"), F.sum(F.col("bad") + F.col("gap")).alias("inversions"))


@query(
    "sorted_tables",
    check_sql(" UNION ALL ".join(f"SELECT '{name}' AS layout, COUNT(*) AS n, CAST(0 AS BIGINT) AS inversions FROM c" for name in ORDERS), c=CALLS),
)
def sorted_tables(spark, sf_dir):
    """Every sort order written and read back in place, with sex chromosomes and a named contig."""
    chrom = F.expr("CASE CHROM WHEN 'chr20' THEN 'chrUn_7' WHEN 'chr21' THEN 'chrX' WHEN 'chr22' THEN 'chrY' ELSE CHROM END")
    calls = written(variants(spark, sf_dir, CALLS).withColumn("CHROM", chrom), "calls")
    found = [
        inversions(sort(calls), scratch_path(spark, "sorted"), key).withColumn("layout", F.lit(name)) for name, (sort, key) in ORDERS.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "chromosome_rank",
    check_sql("SELECT chrom, CAST(SUBSTRING(chrom, 4) AS INTEGER) AS place, COUNT(*) AS n FROM c GROUP BY 1, 2", c=CALLS),
)
def chromosome_rank(spark, sf_dir):
    place = L.chromosome_rank(F.col("CHROM")).alias("place")
    return plain(variants(spark, sf_dir, CALLS).groupBy("CHROM", place).agg(F.count(F.lit(1)).alias("n")))


@query("write_report", check_sql(GENERAL_SQL, c=CALLS))
def write_report(spark, sf_dir):
    """Report tables written to storage; the statistics table is returned."""
    out = scratch_path(spark, "report")
    K.write_report(variants(spark, sf_dir, CALLS), out)
    stats = spark.read.csv(f"{out}/statistics", header=True)
    return plain(stats.withColumn("count", F.col("count").cast("bigint")))


@query(
    "write_report_data",
    check_sql(f"SELECT gene_name, hgvs_p, hgvs_c, rsid, zigosity, {ID}, effect, impact, feature_id, vartype FROM c", c=CALLS),
)
def write_report_data(spark, sf_dir):
    """The same report's data table."""
    out = scratch_path(spark, "report")
    K.write_report(variants(spark, sf_dir, CALLS), out)
    data = spark.read.csv(f"{out}/data", header=True).withColumn("POS", F.col("POS").cast("bigint"))
    return plain(data, "GENE_NAME", "HGVS.P", "HGVS.C", "RSID", "ZIGOSITY", *KEY_NAMES, "EFFECT", "IMPACT", "FEATURE_ID", "VARTYPE")


@query(
    "write_annotated_report",
    cohort_sql(ROWS, f"SELECT {ID}, r.gene_name, freq AS vardb_freq, allele_freq, NULLIF(carriers, '') AS carriers FROM r LEFT JOIN freqs USING ({ID}) LEFT JOIN ({CARRIER_SQL}) k USING ({ID})", r=REPORT),
)
def write_annotated_report(spark, sf_dir):
    out = scratch_path(spark, "annotated")
    report = J.annotate_report(variants(spark, sf_dir, REPORT), variants(spark, sf_dir, ROWS), with_carriers=True)
    K.write_annotated_report(report, out)
    back = spark.read.csv(f"{out}/data", header=True)
    return back.select(
        F.col("CHROM").alias("chrom"), F.col("POS").cast("bigint").alias("pos"), F.col("REF").alias("ref"),
        F.col("ALT").alias("alt"), F.col("GENE_NAME").alias("gene_name"),
        F.col("VARDB_FREQ").cast("double").alias("vardb_freq"), F.col("ALLELE_FREQ").cast("double").alias("allele_freq"),
        F.col("PATS_WITH_VARIANTS").alias("carriers"),
    )


@query(
    "verify_files",
    """SELECT CAST(s_suppkey AS BIGINT) AS supplier, CASE WHEN s_nationkey % 5 = 0 THEN 'failed' WHEN s_nationkey % 5 = 1 THEN 'missing'
  ELSE 'verified' END AS status, CASE WHEN s_nationkey % 5 <> 1 THEN md5(s_name || chr(10)) END AS found_md5 FROM supplier""",
)
def verify_files(spark, sf_dir):
    """One delivered file per supplier, checked against a manifest with wrong and missing entries."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey", "s_name")
    path = scratch_path(spark, "delivered")
    suppliers.filter("s_nationkey % 5 <> 1").select("s_suppkey", "s_name").write.partitionBy("s_suppkey").text(path)
    # Spark names the files themselves, so a delivery is known by its folder.
    files = FS.list_files(spark, path, "*.txt").select(
        "path", F.regexp_extract("path", "s_suppkey=(\\d+)", 1).alias("name")
    )
    manifest = suppliers.selectExpr(
        "CAST(s_suppkey AS STRING) AS name",
        "CASE WHEN s_nationkey % 5 = 0 THEN md5('other') ELSE upper(md5(concat(s_name, '\\n'))) END AS md5",
    )
    return FS.verify_files(files, manifest).select(
        F.col("name").cast("bigint").alias("supplier"), "status", "found_md5"
    )
