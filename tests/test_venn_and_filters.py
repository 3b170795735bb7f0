import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from variantloom.operators import filters as P
from variantloom.operators import venn as V
from variantloom.plans import jobs as J

SCHEMA = "CHROM string, POS bigint, REF string, ALT string, GENE_NAME string, ZIGOSITY string, RSID string, QUAL double"


def table(spark, values):
    return spark.createDataFrame([("chr1", p, "A", "G", g, z, r, 1.0) for p, g, z, r in values], SCHEMA)


@pytest.fixture(scope="module")
def trio(spark):
    return {
        "TEST": table(spark, [(1, "g1", "HOM", None), (2, "g2", "HET", "rs2"), (3, "g3", "HET", "rs3")]),
        "TEST2": table(spark, [(1, "g1", "HET", "rs1"), (3, "g3", "HET", "other"), (4, "g4", "HOM", "rs4")]),
        "TEST23": table(spark, [(1, "g1", "HOM", "rs1"), (5, "g5", "HOM", None)]),
    }


def test_names_containing_each_other(spark, trio):
    merged = V.compare_samples(trio)
    assert rows(merged, "POS", "VENN") == [
        (1, "TEST:TEST2:TEST23"), (2, "TEST"), (3, "TEST:TEST2"), (4, "TEST2"), (5, "TEST23"),
    ]
    counts = dict(rows(V.venn_counts(merged, list(trio)), "VENN", "variants"))
    assert counts == {
        "TEST": 1, "TEST2": 1, "TEST:TEST2": 1, "TEST23": 1, "TEST:TEST23": 0, "TEST2:TEST23": 0, "TEST:TEST2:TEST23": 1,
    }
    assert rows(V.venn_place(merged, "A", list(trio)), "POS") == [(2,)]
    assert rows(V.venn_place(merged, "A:B", list(trio)), "POS") == [(3,)]
    assert V.venn_place(merged, "ALL", list(trio)).count() == 5
    with pytest.raises(ValueError):
        V.venn_place(merged, "D", list(trio))


def test_columns_are_reconciled(spark, trio):
    merged = V.compare_samples(trio)
    assert "GENE_NAME" in merged.columns and "QUAL" not in merged.columns and "RSID" in merged.columns
    assert [c for c in merged.columns if c.startswith("ZIGOSITY")] == ["ZIGOSITY_TEST", "ZIGOSITY_TEST2", "ZIGOSITY_TEST23"]
    # A variant-level column comes from the first sample that has the variant, missing or not.
    assert rows(merged, "POS", "RSID") == [(1, None), (2, "rs2"), (3, "rs3"), (4, "rs4"), (5, None)]
    lazy = V.compare_samples(trio, separate=["ZIGOSITY"])
    assert rows(lazy.select(merged.columns)) == rows(merged)
    long = None
    for name, df in trio.items():
        part = df.withColumn("SAMPLE", F.lit(name))
        long = part if long is None else long.unionByName(part)
    assert rows(V.compare_long(long, list(trio)).select(merged.columns)) == rows(merged)


def test_agreeing_columns_are_kept_once(spark):
    a = table(spark, [(1, "g1", "HOM", "r"), (2, "g2", "HET", "r")])
    b = table(spark, [(1, "g1", "HOM", "r"), (3, "g3", "HET", "r")])
    merged = V.compare_samples({"A": a, "B": b})
    assert rows(merged, "POS", "ZIGOSITY", "VENN") == [(1, "HOM", "A:B"), (2, "HET", "A"), (3, "HET", "B")]


def test_repeated_variant_fails_loudly(spark):
    a = table(spark, [(1, "g1", "HOM", "r"), (1, "g2", "HET", "r")])
    with pytest.raises(Exception, match="variant repeats within sample A"):
        V.compare_samples({"A": a, "B": a.limit(1)}, separate=[]).collect()


def test_regions_partition_the_variants(spark):
    random.seed(5)
    names = ["S", "SS", "T"]
    calls = [(n, "c", random.randrange(60), "A", "G") for n in names for _ in range(40)]
    df = spark.createDataFrame(calls, "SAMPLE string, CHROM string, POS bigint, REF string, ALT string")
    counts = V.venn_counts(V.membership(df, names), names).agg(F.sum("variants")).first()[0]
    assert counts == len({c[2] for c in calls})
    expected = {}
    for pos in {c[2] for c in calls}:
        label = ":".join(n for n in names if any(c[0] == n and c[2] == pos for c in calls))
        expected[label] = expected.get(label, 0) + 1
    got = {v: n for v, n in rows(V.venn_counts(V.membership(df, names), names), "VENN", "variants") if n}
    assert got == expected


def test_membership_is_one_hash_aggregate(spark):
    df = spark.createDataFrame([("S", "c", 1, "A", "G")], "SAMPLE string, CHROM string, POS bigint, REF string, ALT string")
    plan = V.membership(df, ["S", "T"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_shared_and_own(spark, trio):
    assert rows(V.shared_variants(trio["TEST"], trio["TEST2"]), "POS") == [(1,), (3,)]
    assert rows(V.own_variants(trio["TEST"], trio["TEST2"]), "POS") == [(2,)]


def test_text_filter(spark, trio):
    t = trio["TEST"]
    assert rows(P.text_filter(t, ["ZIGOSITY HOM"]), "POS") == [(2,), (3,)]
    assert rows(P.text_filter(t, ["RSID Empty", "GENE_NAME g[3-9]"]), "POS") == [(2,)]
    assert P.text_filter(t).count() == 3
    # A missing cell reads "." in a rule.
    assert rows(P.text_filter(t, ["RSID ^[.]$"]), "POS") == [(2,), (3,)]
    with pytest.raises(ValueError):
        P.text_filter(t, ["ZIGOSITY HOM HET"])


def test_panel(spark, trio):
    genes = spark.createDataFrame([("g3",), ("G1",), ("g1",), ("g1",)], "GeneSymbol string")
    small = P.panel_filter(trio["TEST"], genes)
    large = P.panel_filter(trio["TEST"], genes, max_broadcast_rows=0)
    assert rows(small, "POS") == rows(large, "POS") == [(1,), (3,)]
    ordered = spark.createDataFrame([("g3", 0), ("g1", 1)], "GeneSymbol string, PANEL_POSITION int")
    assert [r["POS"] for r in P.panel_order(trio["TEST"], ordered).collect()] == [3, 1]


def test_compare_job(spark, trio):
    genes = spark.createDataFrame([("g3",), ("g1",)], "GeneSymbol string")
    duo = {n: trio[n] for n in ("TEST", "TEST2")}
    out = J.compare(duo, "A:B", genes, ["ZIGOSITY_TEST HOM"])
    assert rows(out, "POS", "GENE_NAME") == [(3, "g3")]


def test_masks_of_many_samples(spark):
    names = [f"S{i:02d}" for i in range(40)]
    held = {1: [0, 39], 2: [0, 39], 3: [5], 4: [0, 5, 39]}
    data = [(names[i], "chr1", pos, "A", "G") for pos, samples in held.items() for i in samples] + [("other", "chr1", 3, "A", "G"), ("S05", "chr1", 3, "A", "G")]
    calls = spark.createDataFrame(data, "SAMPLE string, CHROM string, POS bigint, REF string, ALT string")
    counts = V.mask_counts(V.presence_masks(calls, names))
    label = V.region_of(F.col("MASK"), names).alias("VENN")
    assert rows(counts.select(label, "variants")) == [("S00:S05:S39", 1), ("S00:S39", 2), ("S05", 1)]
    shared = V.at_least_counts(counts, len(names), 3).select(label, "variants")
    assert rows(shared) == [("S00", 3), ("S00:S05", 1), ("S00:S05:S39", 1), ("S00:S39", 3), ("S05", 2), ("S05:S39", 1), ("S39", 3)]
    with pytest.raises(ValueError, match="63"):
        V.presence_masks(calls, [str(i) for i in range(64)])
