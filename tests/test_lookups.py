"""Indexed files, checksummed differences, packed genotypes and delivery manifests."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from variantloom.operators import checksums as X
from variantloom.operators import cohort as C
from variantloom.operators import genotypes as G
from variantloom.operators import stats
from variantloom.session import written
from variantloom.sources import zone_index as Z
from variantloom.sources.files import read_manifest, verify_files


@pytest.fixture(scope="module")
def sorted_files(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("index") / "t")
    table = spark.range(4000).selectExpr(
        "concat('chr', id % 3 + 1) AS CHROM", "id * 7 AS POS", "'A' AS REF", "'G' AS ALT", "if(id % 10 = 0, NULL, concat('rs', id)) AS RSID"
    )
    Z.write_sorted(table, base, rows_per_file=200)
    Z.write_index(spark, base, base + "-index", ["RSID"])
    return written(table, "table"), base, base + "-index"


def read_files(df):
    return len(df.inputFiles())


def test_only_named_files_are_opened(spark, sorted_files):
    table, path, index = sorted_files
    total = read_files(spark.read.parquet(path))
    assert total >= 18
    point = Z.indexed_lookup(spark, path, index, "chr2", 700)
    assert rows(point) == rows(table.filter("CHROM = 'chr2' AND POS = 700")) and read_files(point) <= 2
    some = Z.indexed_lookup(spark, path, index, "chr1", 5000, 9000)
    assert rows(some) == rows(table.filter("CHROM = 'chr1' AND POS BETWEEN 5000 AND 9000")) and read_files(some) < total / 2
    chrom = Z.indexed_slice(spark, path, index, "chr3")
    assert rows(chrom) == rows(table.filter("CHROM = 'chr3'")) and read_files(chrom) <= total / 3 + 2
    assert Z.indexed_slice(spark, path, index, "chr9").count() == 0


def test_bloom_slices_never_miss(spark, sorted_files):
    table, path, index = sorted_files
    opened = []
    for i in (1, 77, 1234, 3999):
        found = Z.indexed_identifier(spark, path, index, "RSID", f"rs{i}")
        assert rows(found) == rows(table.filter(F.col("RSID") == f"rs{i}")) and found.count() == 1
        opened.append(read_files(found))
    assert sum(opened) <= 8 and Z.indexed_identifier(spark, path, index, "RSID", "rsX").count() == 0


def test_bits_are_those_of_the_bitmap(spark):
    held = [0, 1, 7, 8, 9, 255, 32767]
    bits = spark.createDataFrame([(b,) for b in held], "b bigint").agg(F.bitmap_construct_agg("b").alias("bits"))
    asked = bits.select(*[Z.has_bit(F.col("bits"), F.lit(b).cast("bigint")).alias(f"b{b}") for b in (*held, 2, 10, 32766)]).first()
    assert list(asked) == [True] * len(held) + [False] * 3


def test_differences_by_checksums(spark):
    rng = random.Random(1)
    a = [(rng.randrange(50), rng.choice([None, "x", "y"])) for _ in range(2000)]
    b = list(a)
    b[3] = (999, None)
    b.append(b[7])
    left, right = (spark.createDataFrame(x, "k int, v string") for x in (a, b))
    expected = stats.dataset_diff(left, right).filter("n_left <> n_right")
    assert rows(X.differing_rows(left, right)) == rows(expected)
    same = X.unequal(X.marked(left, ["k", "v"]), X.marked(left.orderBy("v"), ["k", "v"]), X.FIRST_BITS)
    assert same.count() == 0 and X.differing_rows(left, left.repartition(3)).count() == 0
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "v string, w string")
    assert X.differing_rows(swapped.limit(1), swapped.filter("v IS NOT NULL")).count() == 2
    assert X.differing_rows(left.limit(0), left.limit(0)).count() == 0


def test_packed_genotypes_equal_the_long_table(spark):
    rng = random.Random(2)
    cells = {(f"S{s}", p): rng.choice(["HOM", "HET", "UNKWN"]) for s in range(150) for p in range(12) if p == 0 or rng.random() < p / 30}
    values = [(s, "chr1", p, "A", "G", z) for (s, p), z in cells.items()]
    calls = spark.createDataFrame(values, "SAMPLE string, CHROM string, POS bigint, REF string, ALT string, ZIGOSITY string")
    dictionary = G.sample_dictionary(calls)
    packed = G.pack(calls.union(calls.limit(40)), dictionary)
    assert rows(G.unpack(packed, dictionary), "SAMPLE", "POS", "ZIGOSITY") == sorted(((s, p, z) for (s, p), z in cells.items()), key=repr)
    expected = C.cohort_frequencies(calls, unique=True)
    assert rows(G.packed_frequencies(packed, 150), *expected.columns) == rows(expected)
    report = calls.select("CHROM", "POS", "REF", "ALT").filter("POS < 2").distinct()
    found = rows(G.carrier_names(report, packed, dictionary), "POS", "SAMPLE", "N_CARRIERS")
    assert found == sorted(((p, s, sum(1 for t in cells if t[1] == p)) for s, p in cells if p < 2), key=repr)
    assert G.carriers_of(report, packed).filter("POS = 0").count() <= 2 + 150 // (G.PER_WORD * G.WORDS)
    more = spark.createDataFrame([("S3",), ("T1",)], "SAMPLE string")
    wider = {r.SAMPLE: r.NUMBER for r in G.sample_dictionary(more, dictionary).collect()}
    assert {r.SAMPLE: r.NUMBER for r in dictionary.collect()}.items() <= wider.items() and len(set(wider.values())) == 151
    with pytest.raises(Exception, match="without a number: Q"):
        G.pack(calls.withColumn("SAMPLE", F.lit("Q")), dictionary).collect()


def test_manifest_pairs_links_and_checksums_in_order(spark):
    cells = ["download address", "see http://h/readme.txt", "=HYPERLINK(\"https://h/b.tar.gz\",\"b\")", "https://h/a.tar", "https://h/a.pdf", "md5sum", " AB12 ", "cd34", None]
    sheet = spark.createDataFrame(list(enumerate(cells)), "row int, address string")
    manifest = read_manifest(sheet)
    assert rows(manifest, "url", "name", "md5") == [("https://h/a.tar", "a.tar", "cd34"), ("https://h/b.tar.gz", "b.tar.gz", "ab12")]
    none = spark.createDataFrame([], "path string, name string")
    assert rows(verify_files(none, manifest), "name", "status") == [("a.tar", "missing"), ("b.tar.gz", "missing")]
