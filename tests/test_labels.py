import pytest
from pyspark.sql import functions as F

from variantloom.functions import labels as L


def one(spark, value, rule, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(rule(F.col("v"))).first()[0]


CASES = [
    (L.amino_change, {"p.Thr394Thr": ".", "p.Thr1Arg": "CHANGE", "": ".", None: ".", "p.T": "."}),
    (L.clean_hgvs_c, {"c.1A>G": "c.1A>G", "n.null": None, None: None}),
    (L.clinvar_labels, {"5|5": "Pathogenic|Pathogenic", "255,0": "other,Uncertain significance", "9": "9", None: None}),
    (L.polyphen_prediction, {"benign:0.0": "benign", ".": None, ".,x.:1": "x", None: None}),
    (L.polyphen_score, {"benign:0.0": "0.0", "a:0.9,b:0.1": "0.9", "a": None, None: None}),
    (L.to_double, {"1e3": 1000.0, "0.1234567": 0.123457, "1d": None, "nan": None, "a": None, "1,2": None, "-inf": float("-inf")}),
    (L.to_integer, {" 12 ": 12, "1.5": None, "138,129": None, "x": None}),
    (L.chromosome_rank, {"chr2": 2, "11": 11, "chrX": 30, "Y": 40, "chrM": None}),
    (L.first_rsid, {"rs1,rs2;rs3": "rs1", "COSM1;rs5": "rs5", "x,77": "77", "x": ".", None: None}),
    (L.leading_rsid, {"COSM1;rs5": "COSM1", None: None}),
    (L.dosage, {"HOM": 2, "HET": 1, "UNKWN": 0}),
    (L.table_safe, {"A-b-C": "a_b_c"}),
    (L.effect_rank, {"exon_loss_variant": 1, "splice_region_variant&intron_variant": 15, "transcript": 31, "other": None, None: None}),
    (L.export_text, {"": ".", "nan": ".", None: ".", "x": "x"}),
]


@pytest.mark.parametrize("rule, values", CASES, ids=[rule.__name__ for rule, _ in CASES])
def test_rule(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]
    assert got == list(values.values())


def test_esp_and_sample_base(spark):
    assert one(spark, "6.2324,11.669,.", lambda c: L.esp_frequency(c, 0)) == 0.062324
    assert one(spark, "6.2324,11.669,.", lambda c: L.esp_frequency(c, 2)) is None
    assert one(spark, "6.2", lambda c: L.esp_frequency(c, 1)) is None
    assert one(spark, "P1_done", lambda c: L.sample_base(c, "_done")) == "P1"
    assert one(spark, "P1", lambda c: L.sample_base(c, "_done")) == "P1"
