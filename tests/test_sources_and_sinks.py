import hashlib
from types import SimpleNamespace

import pytest
from conftest import rows
from test_flatten import write

from variantloom.operators import cohort as C
from variantloom.operators.flatten import flatten_vcf
from variantloom.plans import jobs as J
from variantloom.session import is_small, scratch_path, small_side
from variantloom.sources import files as FS
from variantloom.sources import sinks as K
from variantloom.sources import tables as T


def test_cohort_csv_with_different_headers(spark, tmp_path):
    (tmp_path / "dbchr1.csv").write_text("CHROM,POS,REF,ALT,FREQ,S1\nchr1,5,A,G,0.5,HOM\n")
    (tmp_path / "dbchr2.csv").write_text("POS,CHROM,REF,ALT,S2,FREQ\n7,chr2,A,G,HET,bad\n")
    table = T.read_cohort_csv(spark, str(tmp_path))
    assert rows(table, "CHROM", "POS", "FREQ", "S1", "S2") == [("chr1", 5, 0.5, "HOM", None), ("chr2", 7, None, None, "HET")]
    assert T.read_cohort_csv(spark, str(tmp_path), ["CHROM", "POS"]).columns == ["CHROM", "POS"]


def test_panel_files(spark, tmp_path):
    (tmp_path / "panel.csv").write_text("GeneSymbol,Note\nA,x\nB,\nA,y\n")
    assert rows(T.read_panel(spark, str(tmp_path / "panel.csv"))) == [("A",), ("B",)]


def test_partition_range_reads_only_its_folders(spark, tmp_path):
    for day in ("1999-01-01", "2005-05-05", "2015-01-01"):
        folder = tmp_path / f"part={day[:4]}" / f"date={day}"
        folder.mkdir(parents=True)
        (folder / "test.csv").write_text("id,value\n1,x\n")
    table = T.read_partitioned_csv(
        spark, str(tmp_path), {"part": "int", "date": "date"}, "date", "2000-01-01", "2012-12-12"
    )
    assert rows(table.selectExpr("part", "string(date) AS d")) == [(2005, "2005-05-05")]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_chromosome_csvs_are_sorted_and_formatted(spark, tmp_path):
    table = spark.createDataFrame(
        [("chr2", 9, 0.5), ("chr1", 8, 1 / 3), ("chr1", 3, 1.0)], "CHROM string, POS bigint, FREQ double"
    )
    K.write_cohort_by_chrom(table, str(tmp_path / "db"))
    lines = [line for f in sorted((tmp_path / "db" / "BY_CHROM=chr1").glob("*.csv")) for line in f.read_text().split("\n")]
    assert [line for line in lines if line and not line.startswith("CHROM")] == ["chr1,3,1.00000", "chr1,8,0.33333"]


def test_select_sample_files(spark):
    paths = ["/a/S1.final.vcf", "/b/S1_done.final.vcf", "/c/S2.final.vcf", "/d/S2.final.vcf", "/e/S3.Final.vcf", "/f/x.vcf", "/g/S5_done.final.vcf"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    known = spark.createDataFrame([("S3_done",), ("S5",)], "SAMPLE string")
    assert rows(FS.select_sample_files(files, "_done", known)) == [("/b/S1_done.final.vcf", "S1_done"), ("/c/S2.final.vcf", "S2")]
    assert FS.select_sample_files(files, "_done").count() == 4


def test_verify_files(spark, tmp_path):
    (tmp_path / "ok.tar").write_bytes(b"abc" * 1000)
    (tmp_path / "bad.tar").write_bytes(b"abc")
    good = hashlib.md5(b"abc" * 1000).hexdigest()
    manifest = spark.createDataFrame([("ok.tar", good), ("bad.tar", good), ("gone.tar", good)], "name string, md5 string")
    checked = FS.verify_files(FS.list_files(spark, str(tmp_path)), manifest)
    assert rows(checked, "name", "status") == [("bad.tar", "failed"), ("gone.tar", "missing"), ("ok.tar", "verified")]


def test_reports(spark, tmp_path):
    panel = tmp_path / "panel.csv"
    panel.write_text("GeneSymbol\nG1\nG2\n")
    one = write(tmp_path / "one.vcf", "P1")
    two = write(tmp_path / "two.vcf", "P2")
    J.single_report(spark, one, str(panel), str(tmp_path / "single"))
    data = spark.read.csv(str(tmp_path / "single" / "data"), header=True)
    assert data.columns[:2] == ["GENE_NAME", "AMINOCHANGE"] and data.filter("GENE_NAME NOT IN ('G1', 'G2')").count() == 0
    cohort = str(tmp_path / "cohort")
    K.write_cohort(C.to_calls(flatten_vcf(spark, [one, two])), cohort)
    J.single_report(spark, one, str(panel), str(tmp_path / "annotated"), cohort, with_carriers=True)
    annotated = spark.read.csv(str(tmp_path / "annotated" / "data"), header=True)
    assert annotated.columns[7:9] == ["VARDB_FREQ", "ALLELE_FREQ"]
    assert rows(annotated.select("PATS_WITH_VARIANTS").distinct()) == [("P1,P2",)]
    J.comparison_report(spark, [one, two], str(tmp_path / "diff"))
    diff = spark.read.csv(str(tmp_path / "diff" / "data"), header=True)
    assert rows(diff.groupBy("VENN").count()) == [("P1:P2", 9)]
    assert spark.read.csv(str(tmp_path / "diff" / "statistics"), header=True).count() > 0
    J.parse_vcf(spark, one, str(tmp_path / "flat"), "csv")
    assert spark.read.csv(str(tmp_path / "flat"), header=True).count() == 9
    with pytest.raises(ValueError):
        J.parse_vcf(spark, one, str(tmp_path / "flat2"), "xml")


def test_append_and_replace(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "SAMPLE string, n int")
    path = str(tmp_path / "t")
    K.write_flat_parquet(df, path, ["SAMPLE"])
    K.write_flat_parquet(df.filter("n = 1"), path, ["SAMPLE"])
    assert spark.read.parquet(path).count() == 2
    K.write_flat_parquet(df.filter("n = 1"), path, ["SAMPLE"], append=True)
    assert spark.read.parquet(path).count() == 3


def test_size_check(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    assert is_small(df, 100) and not is_small(df, 99) and not is_small(df, 100, max_bytes=1000)
    assert "ResolvedHint (strategy=broadcast)" in small_side(df)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in small_side(df, 10)._jdf.queryExecution().analyzed().toString()


def test_size_check_counts_binary_and_nested_cells(spark):
    text = "repeat('x', 100000)"
    for cell in (f"CAST({text} AS BINARY)", f"array({text})", "array_repeat(1, 10000)", f"map(1, {text})", f"struct({text} AS t)", f"array(struct(array({text})))"):
        df = spark.range(10).selectExpr("id", f"{cell} AS c")
        assert is_small(df, max_bytes=2_000_000) and not is_small(df, max_bytes=900_000), cell
    assert is_small(spark.range(10).selectExpr("CAST(NULL AS BINARY) AS b", "CAST(NULL AS ARRAY<STRING>) AS a"), max_bytes=2_000)


def session_without_folder(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master=master))


def test_only_a_local_session_gets_its_own_folder():
    assert scratch_path(session_without_folder("local[8]"), "x").startswith("/tmp/run-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session_without_folder("yarn"), "x")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared) and scratch_path(spark, "x") != scratch_path(spark, "x")
