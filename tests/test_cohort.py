import pytest
from conftest import rows
from test_flatten import ann, record, write
from pyspark.sql import functions as F

from variantloom.operators import cohort as C
from variantloom.plans import jobs as J
from variantloom.sources import sinks as K
from variantloom.sources import tables as T
from variantloom.sources.vcf import load_header, header_lines, read_lines
from variantloom.streaming.cohort_stream import stream_cohort

SCHEMA = "SAMPLE string, CHROM string, POS bigint, REF string, ALT string, ZIGOSITY string, GENE_NAME string, `HGVS.C` string, `HGVS.P` string"


def calls(spark, values):
    return spark.createDataFrame([(s, "chr1", p, "A", "G", z, g, "c.1", "p.1") for s, p, z, g in values], SCHEMA)


@pytest.fixture(scope="module")
def cohort(spark):
    return calls(spark, [
        ("S1", 1, "HOM", "g1"), ("S1", 1, "HOM", "g9"), ("S2", 1, "HET", "g1 | g2"), ("S3", 1, "UNKWN", "g1"),
        ("S1", 2, "HET", "g2"), ("S4", 3, ".", "g3"),
    ])


def test_frequencies(spark, cohort):
    freqs = C.cohort_frequencies(cohort)
    assert rows(freqs, "POS", "N_CARRIERS", "N_ALLELES", "FREQ", "ALLELE_FREQ") == [
        (1, 3, 3, 0.75, 0.375), (2, 1, 1, 0.25, 0.125),
    ]


def test_merged_batches_equal_a_full_count(spark, cohort):
    parts = [C.carrier_stats(cohort.filter(F.col("SAMPLE") == s)) for s in ("S1", "S2", "S3", "S4")]
    assert rows(C.merge_stats(*parts)) == rows(C.carrier_stats(cohort))


def test_allele_frequency_lies_between_half_and_whole(spark, cohort):
    known = C.cohort_frequencies(cohort.filter("ZIGOSITY IN ('HOM', 'HET')"))
    assert known.filter("ALLELE_FREQ < FREQ / 2 OR ALLELE_FREQ > FREQ").count() == 0


def test_labels(spark, cohort):
    assert rows(C.cohort_labels(cohort, ["GENE_NAME"]), "POS", "GENE_NAME") == [(1, "g1 | g2 | g9"), (2, "g2"), (3, "g3")]


def test_table(spark, cohort):
    expected = [
        (1, "g1 | g2 | g9", 3, 3, 0.75, 0.375), (2, "g2", 1, 1, 0.25, 0.125), (3, "g3", 0, 0, 0.0, 0.0),
    ]
    columns = ["POS", "GENE_NAME", "N_CARRIERS", "N_ALLELES", "FREQ", "ALLELE_FREQ"]
    assert rows(C.cohort_table(cohort), *columns) == expected
    assert rows(C.cohort_table(cohort.filter("GENE_NAME <> 'g9'"), unique=True).filter("POS > 1"), *columns) == expected[1:]


def test_matrix_round_trip(spark, cohort):
    called = cohort.filter("ZIGOSITY <> '.'")
    matrix = C.cohort_matrix(called, ["S1", "S2", "S3"])
    assert rows(matrix, "POS", "S1", "S2", "S3") == [(1, "HOM", "HET", "UNKWN"), (2, "HET", ".", ".")]
    back = C.matrix_to_calls(matrix, ["S1", "S2", "S3"])
    assert rows(back, "SAMPLE", "POS", "ZIGOSITY") == rows(called.select("SAMPLE", "POS", "ZIGOSITY").distinct())
    with pytest.raises(Exception, match="sample not listed"):
        C.cohort_matrix(called, ["S1"]).collect()


def test_annotation(spark, cohort):
    report = spark.createDataFrame(
        [("chr1", 1, "A", "G", 9.9), ("chr1", 7, "A", "G", 9.9)], "CHROM string, POS bigint, REF string, ALT string, FREQ double"
    )
    out = J.annotate_report(report, cohort, with_carriers=True)
    assert rows(out, "POS", "VARDB_FREQ", "ALLELE_FREQ", "PATS_WITH_VARIANTS") == [
        (1, 0.75, 0.375, ["S1", "S2", "S3"]), (7, None, None, []),
    ]


def test_cohort_is_replaced_not_doubled(spark, cohort, tmp_path):
    path = str(tmp_path / "cohort")
    K.write_cohort(cohort, path)
    K.write_cohort(cohort.filter("SAMPLE = 'S1'"), path)
    assert rows(T.read_cohort_parquet(spark, path), *cohort.columns) == rows(cohort)
    with pytest.raises(ValueError, match="already"):
        J.add_sample(spark, cohort.filter("SAMPLE = 'S2'"), path)
    with pytest.raises(ValueError, match="exactly one"):
        J.add_sample(spark, cohort, path)
    J.add_sample(spark, calls(spark, [("S9", 4, "HET", "g")]), path)
    assert T.read_cohort_parquet(spark, path).count() == cohort.count() + 1


def one_record(i):
    return [record(i, "A", "G", "AC=1;HET;ANN=" + ann("G", "intron_variant"))]


def test_build_cohort_takes_new_samples_only(spark, tmp_path):
    folder, cohort = tmp_path / "in", str(tmp_path / "cohort")
    folder.mkdir()
    write(folder / "S1.final.vcf", "S1", one_record(1))
    write(folder / "S1_done.final.vcf", "S1_done", one_record(2))
    write(folder / "S2.FINAL.vcf", "S2", one_record(3))
    write(folder / "S3.vcf", "S3", one_record(4))
    assert J.build_cohort(spark, str(folder), cohort, "_done") == 2
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1_done", 2), ("S2", 3)]
    assert J.build_cohort(spark, str(folder), cohort, "_done") == 0
    write(folder / "S4.final.vcf", "S4", one_record(5))
    assert J.build_cohort(spark, str(folder), cohort, "_done") == 1
    assert T.read_cohort_parquet(spark, cohort).count() == 3


def test_stream_ingests_each_file_once(spark, tmp_path):
    folder, cohort, checkpoint = tmp_path / "in", str(tmp_path / "cohort"), str(tmp_path / "checkpoint")
    folder.mkdir()
    first = write(folder / "a.vcf", "S1", one_record(1))
    write(folder / "b.vcf", "S2", one_record(2))
    write(folder / "e.vcf", "S0", [])
    header = load_header(header_lines(read_lines(spark, first)))
    stream_cohort(spark, str(folder), cohort, checkpoint, header, files_per_batch=1).awaitTermination()
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1", 1), ("S2", 2)]
    write(folder / "c.vcf", "S3", one_record(3))
    query = stream_cohort(spark, str(folder), cohort, checkpoint, header)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] < 30
    assert J.cohort_size(spark, cohort) == 4  # S0 has no variant
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1", 1), ("S2", 2), ("S3", 3)]


def test_later_files_of_a_sample_add_to_it(spark, tmp_path):
    folder, cohort, checkpoint = tmp_path / "in", str(tmp_path / "cohort"), str(tmp_path / "checkpoint")
    folder.mkdir()
    first = write(folder / "a.vcf", "S1", one_record(1))
    header = load_header(header_lines(read_lines(spark, first)))
    stream_cohort(spark, str(folder), cohort, checkpoint, header).awaitTermination()
    write(folder / "b.vcf", "S1", one_record(9))
    stream_cohort(spark, str(folder), cohort, checkpoint, header).awaitTermination()
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1", 1), ("S1", 9)]
    # All files once more: every part is replaced by itself.
    stream_cohort(spark, str(folder), cohort, checkpoint + "-again", header).awaitTermination()
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1", 1), ("S1", 9)]


def test_samples_without_variants_count_and_headers_name_samples(spark, tmp_path):
    folder, cohort = tmp_path / "in", str(tmp_path / "cohort")
    folder.mkdir()
    write(folder / "file1.final.vcf", "S1", one_record(1))
    write(folder / "file2.final.vcf", "S2", [])
    write(folder / "other.final.vcf", "S1_done", one_record(2))
    assert J.build_cohort(spark, str(folder), cohort, "_done") == 2
    assert rows(T.read_cohort_parquet(spark, cohort), "SAMPLE", "POS") == [("S1_done", 2)]
    assert J.cohort_size(spark, cohort) == 2
    assert J.build_cohort(spark, str(folder), cohort, "_done") == 0
    report = spark.createDataFrame([("chr1", 2, "A", "G")], "CHROM string, POS bigint, REF string, ALT string")
    out = J.annotate_report(report, T.read_cohort_parquet(spark, cohort), n_samples=J.cohort_size(spark, cohort))
    assert rows(out, "VARDB_FREQ", "ALLELE_FREQ") == [(0.5, 0.25)]
