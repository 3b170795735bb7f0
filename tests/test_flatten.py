import gzip
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from variantloom.operators import cohort as C
from variantloom.operators import flatten as X
from variantloom.operators import venn as V
from variantloom.plans import jobs as J
from variantloom.sources import vcf as S

FIELDS = (
    "Allele | Annotation | Annotation_Impact | Gene_Name | Gene_ID | Feature_Type | Feature_ID | "
    "Transcript_BioType | Rank | HGVS.c | HGVS.p | cDNA.pos / cDNA.length | CDS.pos / CDS.length | "
    "AA.pos / AA.length | Distance | ERRORS / WARNINGS / INFO"
)
HEADER = [
    "##fileformat=VCFv4.1",
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count, for each ALT">',
    '##INFO=<ID=SAMPLES_AF,Number=A,Type=Float,Description="-">',
    '##INFO=<ID=HOM,Number=0,Type=Flag,Description="-">',
    '##INFO=<ID=HET,Number=0,Type=Flag,Description="-">',
    '##INFO=<ID=VARTYPE,Number=A,Type=Flag,Description="-">',
    '##INFO=<ID=ESP6500_MAF,Number=.,Type=String,Description="-">',
    '##INFO=<ID=ESP6500_PH,Number=.,Type=String,Description="-">',
    '##INFO=<ID=CLINVAR_CLNSIG,Number=.,Type=String,Description="-">',
    f"##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: '{FIELDS}' \">",
    "##contig=<ID=chr1,length=249250621,assembly=x>",
]


def ann(allele, effect, gene="G1", c="c.1A>G", p=""):
    return "|".join([allele, effect, "LOW", gene, gene, "transcript", "NM_1", "Coding", "1/1", c, p] + [""] * 5)


def record(pos, ref, alt, info, ident=".", qual="50", flt="PASS"):
    return "\t".join(["chr1", str(pos), ident, ref, alt, qual, flt, info, "GT", "0/1"])


RECORDS = [
    # three alleles; parentheses and per-allele values
    record(10, "A", "C,G,T", "AC=1,2,3;SAMPLES_AF=0.1,0.2,0.3;HOM;VARTYPE=SNP,SNP,MNP;CLINVAR_CLNSIG=5(x),0,255;ANN="
           + ",".join([ann("G", "intron_variant"), ann("C", "missense_variant", p="p.Thr1Arg"), ann("T", "synonymous_variant")])),
    # repeated variant: the second record counts
    record(20, "A", "G", "AC=1;HET;ANN=" + ann("G", "stop_gained")),
    record(20, "A", "G", "AC=2;HOM;ANN=" + ann("G", "intron_variant", c="c.null"), ident="rs7;rs8"),
    # repeated INFO key: the last value counts
    record(30, "C", "T", "AC=1;HET;AC=7;ANN=" + ann("T", "intron_variant")),
    # unknown effects sort after known ones, by text; ties keep input order
    record(40, "C", "T", "AC=1;ANN=" + ",".join([ann("T", "zzz"), ann("T", "aaa", "G2"), ann("T", "aaa", "G3")])),
    record(41, "C", "T", "AC=1;ANN=" + ",".join([ann("T", "aaa"), ann("T", "transcript", "G4"), ann("T", "transcript&x", "G5")])),
    # another allele's annotation loses whatever its rank
    record(42, "C", "T", "AC=1;ANN=" + ",".join([ann("A", "stop_gained"), ann("T", "intron_variant", "G6")])),
    # no annotation
    record(50, "C", "T", "AC=1"),
    # odd numbers
    record(60, "C", "T", "AC=x;SAMPLES_AF=1d;ESP6500_MAF=0.0,0.0457,bad;ESP6500_PH=probably-damaging.:0.9,benign:0.1;ANN=" + ann("T", "stop_lost"), qual="."),
]


def write(path, sample="P1", records=RECORDS, opener=open, header=HEADER):
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"] + (["FORMAT", sample] if sample else [])
    with opener(path, "wt") as out:
        out.write("\n".join([*header, "\t".join(columns), *records]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def vcf(tmp_path_factory):
    return write(tmp_path_factory.mktemp("vcf") / "one.vcf")


def test_header(spark, vcf):
    lines = S.read_lines(spark, vcf)
    header = S.load_header(S.header_lines(lines))
    assert header.types["AC"] == "Integer" and header.types["SAMPLES_AF"] == "Float"
    assert header.ann_fields == FIELDS.split(" | ")
    assert rows(S.sample_names(S.header_lines(lines)), "SAMPLE") == [("P1",)]
    assert rows(S.contig_lengths(S.header_lines(lines))) == [("chr1", 249250621)]
    by_scan = lines.filter(F.col("line").startswith("#")).select("file", "line")
    assert rows(by_scan) == rows(S.header_lines(lines))


def test_flatten_prioritized(spark, vcf):
    got = {(r["POS"], r["ALT"]): r for r in X.flatten_vcf(spark, vcf).collect()}
    assert sorted(got) == [
        (10, "C"), (10, "G"), (10, "T"), (20, "G"), (30, "T"), (40, "T"), (41, "T"), (42, "T"), (60, "T"),
    ]
    assert [got[10, a]["AC"] for a in "CGT"] == [1, 2, 3]
    assert [got[10, a]["SAMPLES_AF"] for a in "CGT"] == [0.1, 0.2, 0.3]
    assert [got[10, a]["EFFECT"] for a in "CGT"] == ["missense_variant", "intron_variant", "synonymous_variant"]
    assert got[10, "C"]["CLINVAR_CLNSIG"] == "Pathogenicx" and got[10, "T"]["CLINVAR_CLNSIG"] == "other"
    assert got[10, "C"]["AMINOCHANGE"] == "CHANGE" and got[10, "G"]["AMINOCHANGE"] == "."
    assert got[20, "G"]["AC"] == 2 and got[20, "G"]["ZIGOSITY"] == "HOM"
    assert got[20, "G"]["RSID"] == "rs7;rs8" and got[20, "G"]["HGVS.C"] is None
    assert got[30, "T"]["AC"] == 7 and got[30, "T"]["ZIGOSITY"] == "HET"
    assert got[40, "T"]["GENE_NAME"] == "G2" and got[41, "T"]["GENE_NAME"] == "G4"
    assert got[42, "T"]["GENE_NAME"] == "G6"
    odd = got[60, "T"]
    assert (odd["AC"], odd["SAMPLES_AF"], odd["QUAL"]) == (None, None, None)
    assert (odd["ESP6500_MAF_EA"], odd["ESP6500_MAF_AA"], odd["ESP6500_MAF_ALL"]) == (0.0, 0.000457, None)
    assert (odd["POLYPHEN_PRED"], odd["POLYPHEN_SCORE"]) == ("probably-damaging", "0.9")
    assert {r["SAMPLE"] for r in got.values()} == {"P1"}


def test_flatten_all_annotations(spark, vcf):
    table = X.flatten_vcf(spark, vcf, prioritized=False)
    assert table.filter("POS = 10").count() == 9
    assert table.filter("POS = 20").count() == 1
    assert table.filter("POS = 50").count() == 0


def test_custom_ranks(spark, vcf):
    table = X.flatten_vcf(spark, vcf, prioritized={"zzz": 1})
    assert rows(table.filter("POS = 40"), "EFFECT") == [("zzz",)]


def test_first_rest(spark, vcf):
    records, _ = S.read_vcf(spark, vcf)
    split = X.split_multiallelic(records, mode="first_rest").filter("POS = 10")
    assert rows(split, "ALT", "AC") == [("C", "1"), ("G,T", "2,3")]
    with pytest.raises(ValueError):
        X.split_multiallelic(records, mode="other")


def test_split_allele_meets_other_record(spark, tmp_path):
    """The same allele from two records is one variant: the more severe annotation wins."""
    path = write(tmp_path / "m.vcf", records=[
        record(10, "A", "C,G", "AC=1,1;HET;ANN=" + ann("G", "intron_variant", "LEFT")),
        record(10, "A", "G", "AC=2;HOM;ANN=" + ann("G", "stop_gained", "RIGHT")),
    ])
    assert rows(X.flatten_vcf(spark, path).filter("ALT = 'G'"), "GENE_NAME", "AC") == [("RIGHT", 2)]


def test_sample_falls_back_to_file_name_and_gzip(spark, tmp_path):
    write(tmp_path / "plain.vcf.gz", sample=None, opener=gzip.open)
    write(tmp_path / "named.vcf", sample="P9")
    table = X.flatten_vcf(spark, str(tmp_path), recursive=True)
    assert rows(table.groupBy("SAMPLE").count()) == [("P9", 9), ("plain.vcf.gz", 9)]


def test_large_file_splits_keep_the_last_record(spark, tmp_path):
    """Line order survives when a file is cut into many splits."""
    lines = [record(100 + i % 50, "A", "G", f"AC={i};HET;ANN=" + ann("G", "intron_variant")) for i in range(2000)]
    path = write(tmp_path / "big.vcf", records=lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        records, header = S.read_vcf(spark, path)
        assert records.rdd.getNumPartitions() > 5
        got = rows(X.flatten_records(records, header), "POS", "AC")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(((100 + i % 50, i) for i in range(1950, 2000)), key=repr)


def test_finalize(spark, vcf):
    table = X.finalize_strings(X.flatten_vcf(spark, vcf).filter("POS = 60"))
    row = table.first()
    assert row["AC"] == "." and row["POS"] == 60 and row["ESP6500_MAF_EA"] == "0.0"
    assert {kind for name, kind in table.dtypes if name != "POS"} == {"string"}


def test_plan_parses_each_line_once(spark, vcf):
    plan = X.flatten_vcf(spark, vcf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("str_to_map") == 1
    assert plan.count("WindowGroupLimit") == 4


FIXTURES = os.environ.get("VCF_FIXTURE_DIR")


@pytest.mark.skipif(not FIXTURES, reason="VCF_FIXTURE_DIR names no folder with the three annotated sample files")
def test_known_samples(spark):
    table = X.flatten_vcf(spark, FIXTURES, recursive=True).cache()
    assert rows(table.groupBy("SAMPLE").count()) == [("TEST", 35), ("TEST2", 7), ("TEST3", 19)]
    every = X.flatten_vcf(spark, FIXTURES, prioritized=False, recursive=True)
    assert rows(every.groupBy("SAMPLE").count()) == [("TEST", 118), ("TEST2", 67), ("TEST3", 93)]
    tables = J.sample_tables(table, ["TEST", "TEST2", "TEST3"])
    counts = V.venn_counts(V.compare_samples(tables), list(tables))
    assert dict(rows(counts.filter("variants > 0"), "VENN", "variants")) == {
        "TEST": 16, "TEST:TEST3": 12, "TEST:TEST2:TEST3": 7,
    }
    duo = {n: tables[n] for n in ("TEST", "TEST2")}
    assert J.compare(duo, "A", rules=["ZIGOSITY HOM"]).count() == 8
    assert J.compare(tables, "A:B:C", rules=["VARTYPE SNP"]).count() == 0
    freqs = C.cohort_frequencies(C.to_calls(table))
    shape = freqs.groupBy(F.round(F.col("FREQ") * 6).alias("f"), F.round(F.col("ALLELE_FREQ") * 6).alias("a")).count()
    assert dict(((f, a), n) for f, a, n in rows(shape)) == {
        (6, 6): 6, (6, 3): 1, (4, 4): 10, (4, 2): 2, (2, 2): 10, (2, 1): 6,
    }
    panel = spark.createDataFrame([("LINC00115",), ("SAMD11",), ("KLHL17",)], "GeneSymbol string")
    assert J.single(tables["TEST"], panel).count() == 16


def mixed_files(folder):
    """An annotated file, one that declares ANN but has none, one without ANN and with other definitions."""
    write_vcf(folder / "a.vcf", "A", HEADER, [record(1, "A", "G", "AC=1;HET;ANN=" + ann("G", "intron_variant", "GA")), record(2, "A", "G", "AC=1")])
    write_vcf(folder / "b.vcf", "B", HEADER, [record(1, "A", "G", "AC=1;NEWKEY=7"), record(3, "A", "C,G", "AC=3,4"), record(3, "A", "G", "AC=5")])
    other = [HEADER[0], '##INFO=<ID=AC,Number=A,Type=String,Description="-">', '##INFO=<ID=AF2,Number=1,Type=Float,Description="-">']
    write_vcf(folder / "c.vcf", "C", other, [record(4, "A", "T", "AC=high;AF2=0.5")])
    swapped = [h.replace("Gene_Name | Gene_ID", "Gene_ID | Gene_Name") for h in HEADER]
    line = ann("G", "intron_variant").split("|")
    line[3], line[4] = "ENSG1", "GD"
    write_vcf(folder / "d.vcf", "D", swapped, [record(5, "A", "G", "AC=1;ANN=" + "|".join(line))])


def write_vcf(path, sample, header, records):
    columns = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])
    path.write_text("\n".join([*header, columns, *records]) + "\n")


@pytest.mark.parametrize("prioritized", [True, False])
def test_files_with_and_without_annotations_together(spark, tmp_path, prioritized):
    mixed_files(tmp_path)
    table = X.flatten_vcf(spark, str(tmp_path), prioritized=prioritized, recursive=True)
    assert rows(table, "SAMPLE", "POS", "ALT", "GENE_NAME", "AC", "NEWKEY") == sorted([
        ("A", 1, "G", "GA", "1", None), ("B", 1, "G", None, "1", "7"), ("B", 3, "C", None, "3", None), ("B", 3, "G", None, "4", None),
        ("B", 3, "G", None, "5", None), ("C", 4, "T", None, "high", None), ("D", 5, "G", "GD", "1", None),
    ], key=repr)


def test_read_samples_takes_names_from_headers(spark, tmp_path):
    mixed_files(tmp_path)
    tables = J.read_samples(spark, [str(tmp_path / "b.vcf"), str(tmp_path / "a.vcf")])
    assert {name: rows(t, "POS") for name, t in tables.items()} == {"B": [(1,), (3,), (3,), (3,)], "A": [(1,)]}
    write_vcf(tmp_path / "e.vcf", "A", HEADER, [])
    with pytest.raises(ValueError, match="comes twice"):
        J.read_samples(spark, [str(tmp_path / "a.vcf"), str(tmp_path / "e.vcf")])
