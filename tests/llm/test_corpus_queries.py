"""The registered corpus queries against their SQL, and the pipeline's decisions, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
import check_queries as check  # noqa: E402

import corpus_pipeline  # noqa: E402
from variantloom.llm import queries, registry  # noqa: E402, F401
from variantloom.llm.decontamination import contaminated  # noqa: E402
from variantloom.llm.jaccard_join import jaccard_components  # noqa: E402
from variantloom.llm.quality_classifier import quality_scores  # noqa: E402
from variantloom.session import written  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", list(registry.CHECKS))
def test_query(spark, name):
    assert check.compare(spark, check.database(SF_DIR), name, SF_DIR).startswith("ok")


def test_pipeline_decisions(spark):
    docs = registry.table(spark, SF_DIR, "documents")
    for (_, stage), left in zip(corpus_pipeline.STAGES[:3], ("quality", "copies", "leaks")):
        out = written(stage(spark, docs, SF_DIR), left)
        assert out.schema.simpleString() == docs.schema.simpleString()
        before, after = ({r[0] for r in x.select("doc_id").collect()} for x in (docs, out))
        if left == "quality":
            gone = {r.doc_id for r in quality_scores(docs, registry.table(spark, SF_DIR, "labels")).filter("predicted = 0").collect()}
        elif left == "copies":
            gone = {r.doc_id for r in jaccard_components(docs).filter("doc_id <> component_id").collect()}
        else:
            gone = {r.doc_id for r in contaminated(docs, registry.table(spark, SF_DIR, "benchmark")).collect()}
        assert after == before - gone and gone
        docs = out
    mixed = written(corpus_pipeline.mix(spark, docs, SF_DIR), "mixed")
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    assert corpus_pipeline.shards(spark, mixed, SF_DIR).count() == mixed.count()


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, None, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() >= 0
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_one_row_of_equal_ones_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    near = " ".join(["changed", *[f"w{i}" for i in range(1, 60)]])
    rows = [(4, text), (None, text), (7, text), (8, near), (None, other), (None, other), (9, ""), (9, ""), (None, ""), (None, None), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars", "5 AS _copies")
    got = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    expected = [(4, text), (None, other), (9, ""), (None, ""), (None, None), (11, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(expected, key=repr)
