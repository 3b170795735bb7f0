"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from variantloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def way(levels, place):
    """Sibling (None where the run is one node) and whether it stands on the left, level by level."""
    out = []
    for level in levels[:-1]:
        at = place ^ 1
        out.append((level[at] if at < len(level) else None, at < place))
        place >>= 1
    return out


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(groups[lang], key=lambda x: x[:3])]) for lang in langs}
    crown = tree([trees[lang][-1][0] for lang in langs]) if langs else None
    out = []
    for i, lang in enumerate(langs):
        for place, (_, _, digest, row) in enumerate(sorted(groups[lang], key=lambda x: x[:3])):
            path = way(trees[lang], place) + way(crown, i)
            hit = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf((*row[:3], row[3] + 1, row[4])) if hit else digest
            for sibling, left in path:
                folded = sha(folded) if sibling is None else sha(sibling, folded) if left else sha(folded, sibling)
            proof = sha(*[s for s, _ in path if s is not None])
            out.append((row[0], digest, trees[lang][-1][0], crown[-1][0], proof, folded, folded == crown[-1][0]))
    return sorted(out, key=repr)


def table(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [
        (i if i % 13 else None, rng.choice(["a", None]), rng.choice(langs), rng.choice([None, 5, 60]), rng.choice([None, "", "é x", "abc " * rng.randrange(9)]))
        for i in range(n)
    ]
    return rows + rows[:3] if n > 2 else rows


@pytest.mark.parametrize(
    "n, langs",
    [(0, ["a"]), (1, [None]), (65, ["a"]), (400, [f"l{i}" for i in range(90)]), (9000, ["x", "x", "é", "y", None])],
)
def test_proofs_are_those_of_a_plain_tree(spark, n, langs):
    rows = table(n, langs)
    got = merkle.manifest_proofs(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_odd_columns_long_texts_and_repeats(spark):
    rows = [(7, None, None, 3, "word " * 200_000), (7, "s", None, None, None), (None, None, None, None, None)] + [(9, "s", "en", 1, "same")] * 40
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "root": F.lit(None).cast("string")})
    got = merkle.manifest_proofs(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_an_address_serves_no_more_rows_than_a_block(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), merkle.digest(F.col("id").cast("string")).alias("digest"))
    manifest = merkle.build_manifest(rows, "lang", ["doc_id"])
    nodes = manifest.nodes.groupBy("rung").count().collect()
    blocks = -(-20_000 // (1 << merkle.BLOCK_BITS))
    assert {r["rung"]: r["count"] for r in nodes} == {1: -(-20_000 // merkle.WIDTH), 2: blocks}
    claims = manifest.leaves.withColumn("claimed", F.col("digest"))
    folded = merkle.climbed(manifest, claims, ["place"])
    assert [tuple(r) for r in folded.select("folded").distinct().collect()] == [tuple(r) for r in manifest.top.collect()]
    assert spark.conf.get(merkle.RECURSION_ROWS) != "-1"
