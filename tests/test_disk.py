"""What jobs leave on disk while they run: shuffle files, scratch tables, text."""

import glob
import os
import time

import pytest
from conftest import rows

from variantloom.names import KEY
from variantloom.operators import flatten as X
from variantloom.session import discard, scratch_path, written
from variantloom.sources import sinks as K
from variantloom.sources import vcf as V
from workload.flattening import vcf_folder
from workload.relations import HEADER, vcf_lines, write_vcf_text


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


def left_by(spark, act) -> set[str]:
    """Shuffle files that an action leaves; they go in the background."""
    before = shuffle_files(spark)
    act()
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    counts = spark.range(1000).selectExpr("id % 7 AS CHROM", "id AS POS").groupBy("CHROM").count()
    assert not left_by(spark, lambda: written(counts, "counts"))
    assert not left_by(spark, lambda: K.write_flat_parquet(counts, str(tmp_path / "flat"), ["CHROM"]))
    assert sum(n for (n,) in rows(spark.read.parquet(str(tmp_path / "flat")), "count")) == 1000


def test_discard_takes_scratch_tables_only(spark, tmp_path):
    table = written(spark.range(3), "gone")
    folder = os.path.dirname(table.inputFiles()[0]).removeprefix("file://")
    assert os.path.isdir(folder)
    discard(table)
    assert not os.path.exists(folder)
    spark.range(3).write.parquet(str(tmp_path / "kept"))
    with pytest.raises(ValueError):
        discard(spark.read.parquet(str(tmp_path / "kept")))
    assert os.listdir(tmp_path / "kept")


def line(pos: int, alt: str, n: int) -> str:
    return f"chr1\t{pos}\t.\tA\t{alt}\t{n}\tPASS\tAC={n};HOM;ANN={alt.split(',')[0]}|intron_variant|MODIFIER|G{n}\tGT\t0/1"


def text_lines(spark):
    """One place of very many lines, some places of one."""
    many = [("S", "S.vcf", i, line(5, ("C", "C,G", "G")[i % 3], i)) for i in range(600)]
    few = [("S", "S.vcf", 1000 + i, line(100 + i, "T", i)) for i in range(50)] + [("S", "S.vcf", 0, "#CHROM\tPOS")]
    return spark.createDataFrame(many + few, "SAMPLE string, file string, ordinal bigint, line string")


def test_gathered_lines_of_a_hot_place_are_cut_to_the_last(spark):
    lines = text_lines(spark)
    assert V.gathered(lines).count() == 650
    kept = V.gathered(lines, hot_lines=100)
    assert rows(kept.filter("POS = 5"), "ordinal") == [(597,), (598,), (599,)]
    assert kept.count() == 53
    plain, cut, all_of_it = (
        X.flatten_records(V.parse_records(x, list(HEADER.types)), HEADER) for x in (lines, kept, V.gathered(lines))
    )
    names = ["SAMPLE", *KEY, "QUAL", "AC", "GENE_NAME"]
    assert rows(plain, *names) == rows(cut, *names) == rows(all_of_it, *names)
    assert len(rows(cut, "POS")) == 52


def test_flattening_shuffles_the_rows_once(spark):
    table = X.flatten_records(V.parse_records(V.gathered(text_lines(spark)), list(HEADER.types)), HEADER)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_vcf_text_is_compressed_and_its_lines_go(spark):
    folder = vcf_folder(spark, "/root/testdata/sf0.001")
    scratch = os.path.dirname(folder)
    files = glob.glob(f"{folder}/**/part-*", recursive=True)
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert not [f for f in os.listdir(scratch) if f.startswith("vcf-lines")]


def test_compressed_text_holds_every_line(spark):
    lines = vcf_lines(spark, "/root/testdata/sf0.001")
    folder = scratch_path(spark, "text")
    write_vcf_text(lines, folder, 2)
    read = V.read_lines(spark, folder, recursive=True, glob="*.txt.gz").filter("line NOT LIKE '#%'")
    assert rows(read, "line") == rows(lines, "line")
