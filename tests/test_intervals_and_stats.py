import random

import pandas as pd
import pytest
from conftest import rows

from variantloom.operators import intervals as I
from variantloom.operators import stats as S


def intervals(spark, values, extra=""):
    return spark.createDataFrame(values, "CHROM string, START bigint, END bigint" + extra)


def brute_depth(reads, length):
    runs = []
    for chrom in sorted({r[0] for r in reads}):
        depth = [0] * length
        for c, s, e in reads:
            if c == chrom:
                for i in range(s, e):
                    depth[i] += 1
        start = 0
        for i in range(1, length + 1):
            if i == length or depth[i] != depth[start]:
                runs.append((chrom, start, i, depth[start]))
                start = i
    return runs


@pytest.mark.parametrize("seed, width", [(1, 16), (2, 64), (3, 1 << 17)])
def test_depth_runs_equal_counting(spark, seed, width):
    random.seed(seed)
    reads = []
    for _ in range(60):
        s = random.randrange(0, 280)
        reads.append((random.choice(["chr1", "chr2"]), s, s + random.randrange(1, 20)))
    reads += [("chr1", 50, 55)] * 40  # a pile-up
    lengths = spark.createDataFrame([("chr1", 300), ("chr2", 300), ("chr3", 300)], "CHROM string, LENGTH bigint")
    got = rows(I.depth_runs(intervals(spark, reads), lengths, bin_width=width))
    assert got == sorted(brute_depth(reads, 300) + [("chr3", 0, 300, 0)], key=repr)
    inner = rows(I.depth_runs(intervals(spark, reads), bin_width=width))
    assert set(inner) <= set(got) and all(r[3] > 0 or r in got for r in inner)


def test_depth_runs_per_sample(spark):
    reads = spark.createDataFrame(
        [("a", "chr1", 0, 5), ("a", "chr1", 3, 8), ("b", "chr1", 3, 8)], "SAMPLE string, CHROM string, START bigint, END bigint"
    )
    assert rows(I.depth_runs(reads, by=["SAMPLE", "CHROM"])) == [
        ("a", "chr1", 0, 3, 1), ("a", "chr1", 3, 5, 2), ("a", "chr1", 5, 8, 1), ("b", "chr1", 3, 8, 1),
    ]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("width", [7, 100, 1 << 14])
def test_overlaps_equal_all_pairs(spark, broadcast_rows, width):
    random.seed(width)

    def some(n, longest):
        out = []
        for i in range(n):
            s = random.randrange(0, 500)
            out.append((random.choice(["chr1", "chr2"]), s, s + random.randrange(1, longest), f"n{i}"))
        return out

    a, b = some(80, 200), some(50, 30)
    expected = sorted(
        [
            (ca, max(sa, sb), min(ea, eb), na, nb)
            for ca, sa, ea, na in a
            for cb, sb, eb, nb in b
            if ca == cb and sa < eb and sb < ea
        ],
        key=repr,
    )
    left = intervals(spark, a, ", READ string")
    right = intervals(spark, b, ", GENE_EXON string")
    got = I.overlaps(left, right, ["GENE_EXON"], bin_width=width, max_broadcast_rows=broadcast_rows)
    assert rows(got) == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (broadcast_rows > 0)


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_long_intervals_meet_short_ones(spark, broadcast_rows):
    """Runs of 100 Mb and short ones on both sides, on the edges of bins of every level."""
    random.seed(broadcast_rows)
    edges = [64 * 16**i for i in range(6)]

    def some(n):
        out = []
        for i in range(n):
            s = max(0, random.choice(edges) * random.randrange(1, 4) + random.randrange(-70, 70))
            out.append(("chr1", s, s + random.choice([1, 63, 64, 65, 1024, 20_000, 1_000_000, 100_000_000]), f"n{i}"))
        return out

    a, b = some(150), some(150)
    expected = [(ca, max(sa, sb), min(ea, eb), na, nb) for ca, sa, ea, na in a for cb, sb, eb, nb in b if sa < eb and sb < ea]
    left, right = intervals(spark, a, ", READ string"), intervals(spark, b, ", GENE_EXON string")
    got = I.overlaps(left, right, ["GENE_EXON"], bin_width=64, max_broadcast_rows=broadcast_rows)
    assert rows(got) == sorted(expected, key=repr)


def test_a_long_interval_is_a_row_or_two_per_level(spark):
    genome = intervals(spark, [("chr1", 5, 100_000_000), ("chr1", 1 << 26, (1 << 26) + 150)])
    for keys in (I.looking_keys([0, 1], I.JOIN_BIN), I.lying_keys(I.JOIN_BIN), I.looking_keys(range(I.LEVELS), I.JOIN_BIN)):
        assert all(r[0] <= 2 * I.LEVELS for r in I.with_keys(genome, I.JOIN_BIN, keys).selectExpr("size(_keys)").collect())
    # Looked up against exons only (the lowest levels), a long run is asked for in its own bins alone.
    assert I.with_keys(genome, I.JOIN_BIN, I.looking_keys([0], I.JOIN_BIN)).selectExpr("size(_keys)").first()[0] <= 2


def test_overlaps_with_nothing(spark):
    some, none = intervals(spark, [("chr1", 5, 9), ("chr1", 9, 9)]), intervals(spark, [])
    assert I.overlaps(some, none).count() == 0 and I.overlaps(none, some).count() == 0


def test_depth_summary_matches_pandas(spark):
    data = [("chr1", i, i + 1, random.randrange(9), f"G{i % 3}_e{i % 5}_x") for i in range(60)]
    cover = spark.createDataFrame(data, "CHROM string, START bigint, END bigint, DEPTH bigint, EXON string")
    got = I.depth_summary(cover, "GENE").toPandas().set_index("GENE").sort_index()
    frame = pd.DataFrame(data, columns=["CHROM", "START", "END", "DEPTH", "EXON"])
    expected = frame.groupby(frame.EXON.str.split("_").str[0]).DEPTH.describe().drop(columns="count")
    for column in expected.columns:
        assert got[column].round(9).tolist() == expected[column].round(9).tolist()
    assert I.depth_summary(cover.limit(1), "EXON").first()["std"] is None


def test_quantiles_match_pandas(spark):
    random.seed(3)
    data = [(random.choice([1.0, random.gauss(0, 100)]), float(i % 7), None if i % 3 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {r["name"]: r for r in S.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).collect()}
    frame = pd.DataFrame(data, columns=list("abc"), dtype=float)
    for name in "abc":
        for p in (0.0, 0.1, 0.25, 0.5, 0.75, 1.0):
            assert got[name][f"p{round(p * 100)}"] == pytest.approx(frame[name].quantile(p), abs=1e-9)


def test_profile(spark):
    df = spark.createDataFrame([(1, "x"), (3, None)], "n int, `t.x` string")
    got = {r["name"]: r.asDict() for r in S.profile(df).collect()}
    assert got["n"]["mean"] == 2.0 and got["n"]["p50"] == 2.0 and got["n"]["rows"] == 2
    assert got["t.x"]["filled"] == 1 and got["t.x"]["mean"] is None


def test_diffs(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(None, 1, "z"), ("y", 2, "z")], "v string, k int, extra string")
    diff = S.dataset_diff(a, b)
    assert rows(diff) == [(1, None, 2, 1, "both"), (2, "x", 1, 0, "left_only"), (2, "y", 0, 1, "right_only")]
    assert rows(S.diff_counts(diff)) == [("both", 2), ("left_only", 1), ("right_only", 1)]
    assert rows(S.schema_diff(a, b.withColumnRenamed("v", "V"))) == [
        ("EXTRA", "right_only", None, 2), ("K", "both", 3, 2), ("V", "both", 1, 1),
    ]


def test_general_stats_needs_its_columns(spark):
    df = spark.createDataFrame([("c", "HOM", "SNP", "LOW", "e")], "CHROM string, ZIGOSITY string, VARTYPE string, IMPACT string, EFFECT string")
    assert rows(S.general_stats(df)) == [("c", "HOM", "SNP", "LOW", "e", 1)]
    assert S.general_stats(df.drop("IMPACT")) is None


def test_grouped_quantiles_match_pandas(spark):
    """Values of one, two and four digits, negative ones, repeats, NULLs and a group without a value."""
    random.seed(8)
    data = [("small", random.randrange(9)) for _ in range(50)] + [("wide", random.randrange(-(1 << 40), 1 << 40)) for _ in range(60)]
    data += [("same", 70_000)] * 40 + [("one", -5), (None, 3), (None, 4), ("none", None), ("one", None)]
    df = spark.createDataFrame(data, "g string, v bigint")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["_q"] for r in S.grouped_quantiles(df, ["g"], "v", wanted).collect()}
    for group in ("small", "wide", "same", "one", None):
        values = pd.Series([v for g, v in data if g == group and v is not None], dtype=float)
        assert got[group] == pytest.approx([values.quantile(p) for p in wanted], rel=1e-12)
    assert "none" not in got and S.grouped_quantiles(df.limit(0), ["g"], "v", wanted).count() == 0
