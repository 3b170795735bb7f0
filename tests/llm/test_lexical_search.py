"""Ranked lexical search against scores of all documents, and its bounds."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from variantloom.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain(docs, items, top):
    lists = [(doc_id, terms(text)) for doc_id, text in docs]
    n, total = sum(1 for _, t in lists if t), sum(len(t) for _, t in lists)
    df = {}
    for _, t in lists:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for query in {q for q, _ in items}:
        wanted = {x for q, text in items if q == query for x in terms(text)}
        scores = []
        for doc_id, t in lists:
            score = 0
            for x in wanted:
                if tf := t.count(x):
                    m = 50 + 50 * len(t) * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        out += [(query, i + 1, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "日本", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(3, 60)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(words, weights, k=12)) + f" w{rng.randrange(100, 300)}, W{rng.randrange(300)}") for i in range(15)]
    docs += [(n + i, items[i][1] + " " + docs[i][1]) for i in range(10)]
    return docs, items


@pytest.mark.parametrize("top, share", [(5, 1 / 64), (5, 1.0), (50, 0.2), (1, 0.0)])
def test_ranks_are_those_of_all_documents(spark, monkeypatch, top, share):
    monkeypatch.setattr(search, "PAIR_SHARE", share)
    monkeypatch.setattr(search, "SEEDS", 20)
    docs, items = corpus(700, top)
    docs += [(3, docs[3][1]), (None, items[0][1]), (8000, None), (8001, ""), (8002, " ,.; "), (8003, "W5-w6 " * 3000), (8004, docs[9][1])]
    items += [(90, None), (91, ""), (92, "unheard of"), (0, "w7 w250"), (93, "w0")]
    got = search.search(spark.createDataFrame(docs, SCHEMA).withColumn("score", F.lit(1)), spark.createDataFrame(items, "query long, text string"), top)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items, top)


def test_held_terms_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(search, "HELD_TERMS", 0)
    docs, items = corpus(200, 3)
    got = search.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "query long, text string"), 7)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items, 7)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], SCHEMA), spark.createDataFrame([(1, "a")], "query long, text string")
    assert search.search(docs.limit(0), items).count() == 0 and search.search(docs, items.limit(0)).count() == 0


def test_pair_bounds_shut_more_than_single_maxima(spark, monkeypatch):
    """Two rare terms that never meet: together they can add no more than the larger of them."""
    docs = [(i, f"common filler w{i % 7} " + ("left " if i == 3 else "right " if i == 4 else "")) for i in range(400)]
    items = spark.createDataFrame([(1, "left right common filler")], "query long, text string")
    split = search.listed(items.select("query", "text"), "query").select("query", F.explode("terms").alias("term"))
    index = search.build_index(spark.createDataFrame(docs, SCHEMA), split)
    pairs = index.pairs.collect()
    assert [r.joint for r in pairs] == [0]
    assert index.terms.filter("df = 1").count() == 2
