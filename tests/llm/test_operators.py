"""The corpus operators against brute force, and on odd rows: NULLs, empty texts, repeats, clashing names."""

import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.llm import decontamination, jaccard_join, license_scan, line_dedup, mixing, numbering, quality_classifier, quality_rules
from variantloom.llm import class_lm, sharding, substring_dedup
from variantloom.llm.components import components
from variantloom.session import written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, n string, size string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW) if lower else text)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Prose with copies, near copies, shared passages, one long text and odd rows."""
    rng = random.Random(5)
    out = [prose(rng, rng.randrange(60, 200), 4000) for _ in range(40)]
    passage = prose(rng, 70, 4000)
    for i in range(8):
        base = out[i].split(" ")
        copy = list(base)
        for _ in range(1 + i % 2):
            copy[rng.randrange(len(copy))] = "changed"
        out += [" ".join(base), " ".join(copy), prose(rng, 30, 4000) + " " + passage + " " + prose(rng, 40, 4000)]
    out.append(prose(rng, 20000, 9000))
    out += [None, "", " \n\t ", "one", "Two words", "a b c", "A B C", "\n\n\nx", "é ß ÑÇ x", "tie tie tie tie tie tie"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, "x", "y", "z", "v") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return written(spark.createDataFrame(rows, SCHEMA).repartition(5), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# Line-first quality rules

def test_rules_keep_clean_and_reject_furniture(spark):
    rng = random.Random(9)
    clean = "\n".join(prose(rng, 11).capitalize() + ", and so on." for _ in range(12))
    menu = "Home | News | Sport | Weather | Contact\n" * 12 + "One line of text that is fine, more or less, as lines go here."
    rows = [(1, clean), (2, menu), (3, None), (4, ""), (5, "We use cookies.\n" + clean), (6, " ".join(["same"] * 300))]
    got = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[5].kept and got[5].clean_text == clean
    assert not any(got[i].kept for i in (2, 3, 4, 6))
    assert got[3].n_words == 0 and got[3].base_failed and got[6].n_repeat_words == 300


def test_rules_count_as_brute_force(docs, empty):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.judged(docs).collect())
    expected = []
    for doc_id, text in pairs_of(docs):
        w = words(text, lower=False)
        n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        expected.append((doc_id is None, doc_id or 0, len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered)))
    assert got == sorted(expected)
    assert quality_rules.judged(empty).count() == 0


# Sharding

def jump(key, shards):
    key, b, j = key % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 1000])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [0, 1, 2, 7, 123456789, -1, -(1 << 63), (1 << 63) - 1, *range(1000, 1100)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()
    assert {r.k: r.s for r in rows} == {k: jump(k, shards) for k in keys}


def test_growing_moves_rows_only_to_the_new_shard(spark):
    keys = spark.range(20000).select(sharding.jump_hash(F.col("id"), 16).alias("a"), sharding.jump_hash(F.col("id"), 17).alias("b"))
    moved = keys.filter("a <> b")
    assert moved.filter("b <> 16").count() == 0
    assert 0.04 < moved.count() / 20000 < 0.08


def test_shards_of_odd_rows(docs, empty):
    got = sharding.assign_shards(docs, 4)
    assert got.count() == docs.count() and set(got.columns) == set(docs.columns)
    assert all(r.shard == jump(r.doc_id or 0, 4) for r in got.collect())
    assert sharding.assign_shards(empty, 4).count() == 0


def test_numbers_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(numbering, "BUCKET_ROWS", 10)
    rows = [(i % 3 if i % 11 else None, i % 40, 1) for i in range(500)] + [(1, 7, 1)] * 300
    df = written(spark.createDataFrame(rows, "g int, x int, y int"), "numbers")
    got = defaultdict(list)
    for r in numbering.numbered(df, ["g"], ["x"], "slot", first=["y"]).collect():
        got[r.g].append(r.slot)
    expected = Counter(r[0] for r in rows)
    assert {g: sorted(s) for g, s in got.items()} == {g: list(range(n)) for g, n in expected.items()}


# Quality classifier

def test_classifier_learns_and_never_reads_held_out_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 != 0
        text = prose(rng, 80) + "." if good else " ".join(f"w{rng.randrange(400)}###" for _ in range(80))
        held = zlib.crc32(str(i).encode()) % 4 == 2
        rows.append((i, text))
        labels.append((i, int(good) if not held else int(not good)))  # held-out labels are wrong
    rows += [(None, "x"), (1000, None), (1001, ""), (5, rows[5][1])]
    labels += [(None, 1), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("a")).withColumn("quality", F.lit(3))
    got = quality_classifier.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.doc_id % 3 != 0) for r in got if r.doc_id is not None and r.doc_id < 400)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_classifier_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.quality_scores(docs, none).collect()} == {0.5}
    assert quality_classifier.quality_scores(empty, none).count() == 0


# Class language model

def test_lm_counts_and_beats_nothing_held_back(spark, docs, empty):
    got = class_lm.lm_scores(docs).collect()
    rows = pairs_of(docs)
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (doc_id is None, doc_id or 0, len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]),
         round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(t), None]), 6))
        for doc_id, t in rows
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert {r.train_tokens for r in got} == {n} and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert class_lm.lm_scores(empty).count() == 0


def test_rare_words_come_by_the_join(docs, monkeypatch):
    full = {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in class_lm.lm_scores(docs).collect()}
    monkeypatch.setattr(class_lm, "FREQUENT", 16)
    assert {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in class_lm.lm_scores(docs).collect()} == full


def test_exchange_separates_words_by_context(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"{'a' if k % 2 == 0 else 'b'}{rng.randrange(20)}" for k in range(60))) for i in range(200)]
    scores = class_lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    # Knowing the class before halves the choice of words.
    assert sum(r.score - r.base_score for r in scores) / sum(r.n_tokens for r in scores) > 0.2


def test_words_of_equal_counts_keep_their_classes(spark, monkeypatch):
    """More equally frequent words than tasks hold by count: they are clustered all the same."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"{'a' if k % 2 == 0 else 'b'}{k // 2}" for k in rng.sample(range(0, 40, 2), 20) for k in (k, k + 1))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    full = {(r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in class_lm.lm_scores(docs).collect()}
    monkeypatch.setattr(class_lm, "FREQUENT", 16)
    few = {(r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in class_lm.lm_scores(docs).collect()}
    assert {x[:3] for x in few} == {x[:3] for x in full}
    assert all(abs(x[3] - x[2]) > 1 for x in few)


# Mixing

def waterfill(sizes, weights, cap=3.0):
    open_, target, left = dict(weights), {}, sum(sizes.values())
    while True:
        level = left / sum(open_.values()) if open_ else 0
        over = [s for s in open_ if open_[s] * level >= cap * sizes[s]]
        if not over:
            return {**target, **{s: w * level for s, w in open_.items()}}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            del open_[s]


def test_targets_and_rounding(spark):
    rng = random.Random(3)
    names = ["a", "b", "c", "d", "é", "z", None]
    rows = [(i, names[min(int(rng.random() ** 2 * 7), 6)], rng.randrange(0, 400), 1.0) for i in range(1500)]
    rows += [(5, "a", 100, 1.0)] * 200  # one row again and again
    df = written(spark.createDataFrame(rows, "doc_id long, source string, size long, base double"), "mix")
    got = mixing.mixed(df, ["doc_id"]).collect()
    sizes = Counter()
    for _, s, n, _ in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = waterfill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken, largest = Counter(), Counter()
    for r in got:
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
        assert r.copies <= 3 and abs(r.target - target[r.source]) < 1e-6 * target[r.source] + 1e-9
    assert len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in sizes)
    again = mixing.mixed(df, ["doc_id"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_newton_with_base_rates_and_cap(spark):
    rows = [(i, "a", 10, 0.2 + (i % 5)) for i in range(100)] + [(1000 + i, "b", 10, 1.0) for i in range(100)]
    cells = written(spark.createDataFrame(rows, "doc_id long, source string, size long, base double").groupBy("source", "base").agg(F.sum("size").cast("double").alias("tokens")), "cells")
    targets = spark.createDataFrame([("a", 1000, 2500.0), ("b", 1000, 400.0)], "source string, source_size long, target double")
    state = {r.source: r for r in mixing.balanced(cells, targets).collect()}
    given = defaultdict(float)
    for _, s, n, base in rows:
        given[s] += n * min(3.0, base * np.exp(state[s].tilt))
    assert abs(given["a"] - 2500) < 1e-6 and abs(given["b"] - 400) < 1e-6


def test_mixing_nothing(spark, empty):
    none = spark.createDataFrame([], "doc_id long, source string, size long, base double")
    assert mixing.mixed(none, ["doc_id"]).count() == 0


# Line deduplication

def test_lines_as_brute_force(spark, empty):
    rng = random.Random(4)
    common = [("Shared line %d " % k) + "x" * 40 for k in range(6)]
    rows = []
    for i in range(60):
        lines = [prose(rng, 8) for _ in range(3)] + [f"  {rng.choice(common).upper() if i % 2 else rng.choice(common)}\t" for _ in range(4)]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(3, rows[3][1]), (None, common[0]), (None, common[0]), (70, None), (71, ""), (72, common[1] + "\n" + common[1]), (73, "short")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    expected = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or doc_id == max((h for h in holders[key(x)] if h is not None), default=None)]
        expected.append((doc_id is None, doc_id or 0, "\n".join(keep), len(lines), len(lines) - len(keep)))
    assert got == sorted(expected)
    assert line_dedup.deduplicated(empty).count() == 0


# Jaccard join

def shingle_set(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components_as_brute_force(docs, n, percent):
    rows = [(d, shingle_set(t, n)) for d, t in pairs_of(docs)]
    known = [(d, s) for d, s in rows if d is not None]
    parent = {d: d for d, _ in known}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(known, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    got = jaccard_join.jaccard_components(docs, n, percent).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == {(d, root(d)) for d, _ in known}
    assert sorted(r.n_shingles for r in got) == sorted(len(s) for _, s in rows)
    assert {r.component_id for r in got if r.doc_id is None} == {root(4), None}


@pytest.mark.parametrize("percent", [90, 80])
def test_group_bound_is_below_every_member(spark, percent):
    """What a member of any size within a group's needs is never less than the bound of the group."""
    sizes = spark.range(1, 121).select(F.col("id").alias("n"))
    least = sizes.select("n", F.explode(F.sequence(F.ceil(F.col("n") * percent / 100 - 1e-9), F.floor(F.col("n") * 100 / F.lit(percent) + 1e-9))).alias("s"))
    n, s = F.col("n"), F.col("s")
    shared = F.greatest(jaccard_join.rest(n, percent), jaccard_join.rest(s, percent))
    least = least.withColumn("least", jaccard_join.needed(n, s, percent) - shared)
    spans = least.alias("x").join(least.select("n", F.col("s").alias("low")).alias("l"), "n").join(least.select("n", F.col("s").alias("high")).alias("h"), "n")
    spans = spans.filter("low <= s AND s <= high").withColumn("bound", jaccard_join.group_bound(n, F.col("low"), F.col("high"), percent))
    assert spans.filter("bound > least").count() == 0
    # No slack beyond the rounding: a group of one size is bounded by that size within one token.
    assert spans.filter("low = high AND least > 0 AND bound < least - 1").count() == 0


def test_families_of_short_texts_link_across_sizes(spark):
    """Set 28 and member 29 share one prefix token; the member's group spans 27 to 30 (90 %)."""
    member = spark.createDataFrame([(1, 27, 1), (2, 29, 1), (3, 30, 1), (9, 28, 9)], "id long, n long, group long")
    shared = spark.createDataFrame([(7, 2, 29), (7, 9, 28), (5, 1, 27), (5, 3, 30)], "token long, id long, n long")
    assert (9, 2) in {(r.a, r.b) for r in jaccard_join.opened(shared, member, 90).collect()}


def test_join_of_nothing(empty):
    assert jaccard_join.jaccard_components(empty, 3, 90).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


# Decontamination

def test_exact_and_edited_items_are_found(spark, docs, empty):
    rng = random.Random(6)
    items = [(i, prose(rng, 30 + i, 5000)) for i in range(12)] + [(50, "too short"), (51, None), (52, "")]
    rows, planted = [], set()
    for i in range(60):
        text = prose(rng, 150, 5000).split(" ")
        if i % 3 == 0:
            item = items[i % 12][1].split(" ")
            if i % 2:
                item[5], item[15] = "edited", "again"
                del item[20]
            text[40:40] = item
            planted.add((i, i % 12))
        rows.append((i, " ".join(text).upper() if i % 4 == 0 else " ".join(text)))
    rows += [(None, items[0][1]), (70, None), (71, ""), (72, items[2][1] + " " + items[2][1])]
    planted |= {(None, 0), (72, 2)}
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    hits = decontamination.contaminated(table, bench).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == planted
    assert all(r.first_word <= 41 and r.end_word - r.first_word >= 25 for r in hits)
    left = decontamination.decontaminated(table, bench)
    assert left.columns == table.columns and left.count() == len(rows) - len(planted)
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [1, 5, 1000])
@pytest.mark.parametrize("kind", ["edited", "quoted"])
def test_copies_of_a_leak_do_not_hide_it(spark, kind, copies):
    """Every fifth word replaced, or 45 % of the item quoted: found however many documents hold it."""
    rng = random.Random(12)
    item = [f"q{i}" for i in range(60)]
    part = ["else" if i % 5 == 4 else w for i, w in enumerate(item)] if kind == "edited" else item[:27]
    rows = [(i, prose(rng, 20) + " " + " ".join(part) + " " + prose(rng, 20)) for i in range(copies)]
    rows += [(5000 + i, prose(rng, 20) + " q1 q2 q3 q4 " + prose(rng, 20)) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontamination.contaminated(table, bench).collect()}
    assert set(got) == set(range(copies))
    assert min(got.values()) >= (0.65 if kind == "edited" else 0.44)
    assert decontamination.decontaminated(table, bench).count() == 20


def test_hits_of_many_places_come_in_runs_of_whole_texts(monkeypatch):
    monkeypatch.setattr(decontamination, "ENTRIES", 7)
    row, counts = np.array([0, 0, 2, 3, 3, 3, 9]), np.array([2, 2, 5, 1, 9, 1, 3])
    runs = [list(range(len(row)))[cut] for cut in decontamination.runs_of_rows(row, counts)]
    assert runs == [[0, 1], [2, 3, 4, 5], [6]]


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = rng.integers(0, 4, 12), rng.integers(0, 4, 9)
        h = np.zeros((len(b) + 1, len(a) + 1), dtype=int)
        for i in range(1, len(b) + 1):
            for j in range(1, len(a) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[j - 1] == b[i - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontamination.align(a.astype(np.uint64), b.astype(np.uint64))[0] == h.max()


# Passages

def test_passages_as_brute_force(spark, docs, empty):
    got = substring_dedup.repeated_passages(docs).collect()
    held = defaultdict(set)
    for doc_id, text in pairs_of(docs):
        w = words(text)
        for i in range(len(w) - 49):
            held[tuple(w[i : i + 50])].add(doc_id)
    needed = {d for s in held.values() if len(s - {None}) > 1 for d in s - {None}}
    assert needed <= {r.doc_id for r in got} | {r.like_doc_id for r in got}
    by_id = {d: words(t) for d, t in pairs_of(docs)}
    for r in got:
        x = shingle_set(" ".join(by_id[r.doc_id][r.first_word : r.end_word]), 5)
        y = shingle_set(" ".join(by_id[r.like_doc_id][r.like_first_word : r.like_end_word]), 5)
        assert r.end_word - r.first_word >= 50 and abs(len(x & y) / len(x | y) - r.similarity) < 1e-9 and r.similarity >= 0.8
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_equal_passages_meet_whatever_documents_share_their_words(spark):
    """Many documents share a run too short to count; the two that share a whole passage are still found."""
    rng = random.Random(11)
    short, rest = prose(rng, 35), prose(rng, 30)
    rows = [(i, " ".join([prose(rng, 60), short, prose(rng, 60)])) for i in range(40)]
    rows += [(100, " ".join([prose(rng, 60), short, rest, prose(rng, 40)])), (101, " ".join([prose(rng, 20), short, rest, prose(rng, 70)]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert (101, 100) in {(r.doc_id, r.like_doc_id) for r in got} and len(got) == len(set(got))
    held = [r for r in got if (r.doc_id, r.like_doc_id) == (101, 100)]
    assert max(r.end_word - r.first_word for r in held) >= 65


def test_near_passages_with_a_word_put_in_or_left_out_meet(spark):
    """Passages of 52 to 70 words, one word changed, put in or left out: nearly all pairs are found."""
    rng = random.Random(13)
    rows, planted = [], set()
    for i in range(120):
        part = prose(rng, (52, 55, 60, 70)[i % 4], 50000).split(" ")
        copy, at = list(part), rng.randrange(5, len(part) - 5)
        copy[at : at + (i // 4 % 3 != 1)] = [] if i // 4 % 3 == 2 else ["new"]
        rows += [(2 * i + k, " ".join([prose(rng, 60, 50000), *x, prose(rng, 60, 50000)])) for k, x in enumerate((part, copy))]
        planted.add((2 * i + 1, 2 * i))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    found = {(r.doc_id, r.like_doc_id) for r in got}
    assert found <= planted and len(found) >= 0.97 * len(planted)


def test_passages_unlike_their_leader_meet_members_that_are_like_it(spark):
    """Likeness is not transitive: C, like B but not like A, finds B though B went with A."""
    rng = random.Random(17)
    rows, near, equal = [], set(), set()

    def held(i, part):
        rows.append((i, " ".join([prose(rng, 30, 50000), *part, prose(rng, 30, 50000)])))

    for i in range(0, 480, 4):
        if i % 8:
            part = prose(rng, 53 if i % 16 == 4 else 60, 50000).split(" ")
            first, last = list(part), list(part)
            first[rng.randrange(8, 20)], last[rng.randrange(32, 44)] = "new", "other"
            held(i, first), held(i + 1, part), held(i + 2, last), held(i + 3, part)
            near.add((i + 2, i + 1))
        else:
            part = prose(rng, 100, 50000).split(" ")
            held(i, part[:72]), held(i + 1, part), held(i + 2, part[28:80])
            equal.add((i + 2, i + 1))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    found = {(r.doc_id, r.like_doc_id) for r in got}
    assert equal <= found
    assert len(near & found) >= 0.98 * len(near)


def test_a_key_of_many_unlike_members_is_joined_whole(spark, monkeypatch):
    """Groups dealt over several tasks lose no pair."""
    rng = random.Random(18)
    # Long enough to give all of them one key, too short to be a passage.
    short = prose(rng, 48)
    tails = [prose(rng, 12) for _ in range(15)]
    rows = [(i, " ".join([prose(rng, 20), short, tails[i // 2], prose(rng, 20)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = sorted(map(tuple, substring_dedup.repeated_passages(docs).collect()))
    monkeypatch.setattr(substring_dedup, "MEMBERS", 2)
    assert sorted(map(tuple, substring_dedup.repeated_passages(docs).collect())) == whole
    assert {(2 * i + 1, 2 * i) for i in range(1, 15)} <= {(r[0], r[3]) for r in whole}


def test_members_that_share_only_a_phrase_are_not_verified(spark, monkeypatch):
    """The bound on the text around the centres leaves most pairs out and loses none of the passages."""
    rng = random.Random(19)
    phrase, rest = prose(rng, 14, 50000), prose(rng, 50, 50000)
    rows = [(i, " ".join([prose(rng, 50, 50000), phrase, prose(rng, 50, 50000)])) for i in range(120)]
    rows += [(200 + i, " ".join([prose(rng, 50, 50000), phrase, rest, prose(rng, 20, 50000)])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts, real = [], substring_dedup.verified

    def counted(pairs, *args):
        counts.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(substring_dedup, "verified", counted)
    got = sorted(map(tuple, substring_dedup.repeated_passages(docs).collect()))
    monkeypatch.setattr(substring_dedup, "may_be_similar", lambda *args: F.lit(True))
    assert sorted(map(tuple, substring_dedup.repeated_passages(docs).collect())) == got
    assert (201, 200) in {(r[0], r[3]) for r in got}
    assert counts[3] > 100 and counts[1] < counts[3] / 10


def test_surroundings_bound_similar_passages():
    """No pair of similar passages around two centres needs more equal shingles than the bit maps allow."""
    rng, width = np.random.default_rng(20), 46
    for i in range(200):
        size = (3, 20, 10**6)[i % 3]
        part = rng.integers(0, size, 46 + int(rng.integers(0, 30))).astype(np.uint64)
        copy = part.copy()
        copy[rng.integers(0, len(copy), int(rng.integers(0, 5)))] = 10**7
        inter = len(np.intersect1d(part, copy))
        if 100 * inter < 80 * len(np.union1d(part, copy)):
            continue
        at = int(rng.integers(len(part) - 46, 46))
        texts = [np.concatenate([rng.integers(0, size, 60).astype(np.uint64), x, rng.integers(0, size, 60).astype(np.uint64)]) for x in (part, copy)]
        (n, least, marks), (m, other, bits) = (substring_dedup.surroundings(x, np.array([60 + at]), width) for x in texts)
        around = [len(np.unique(x[60 + at - 45 : 60 + at + 46])) for x in texts]
        assert [int(n[0]), int(m[0])] == around and least[0] <= len(np.unique(part)) and other[0] <= len(np.unique(copy))
        differ = sum(int(v).bit_count() for v in marks[0].view(np.uint64) ^ bits[0].view(np.uint64))
        assert (n[0] + m[0] - differ) * 180 >= 160 * (least[0] + other[0])


def test_runs_of_one_word_are_few_places_and_still_meet(spark):
    """Runs of one word in any length meet, with what stands before or behind them, by few of their places."""
    rng = random.Random(21)
    before, behind = prose(rng, 40, 50000), prose(rng, 40, 50000)
    rows = [(0, " ".join([prose(rng, 30, 50000), "of " * 15 + behind])), (1, " ".join([prose(rng, 30, 50000), "of " * 45 + behind]))]
    rows += [(2, " ".join([before, "to " * 15 + prose(rng, 40, 50000)])), (3, " ".join([before, "to " * 45 + prose(rng, 40, 50000)]))]
    rows += [(4 + i, " ".join([prose(rng, 30, 50000), "and " * (90 + 30 * i) + prose(rng, 30, 50000)])) for i in range(3)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.like_doc_id) for r in got} >= {(1, 0), (3, 2), (5, 4), (6, 4)}
    grams = np.array([9, 5, 5, 5, 5, 7, 8], dtype=np.uint64)
    places = substring_dedup.run_windows(grams, np.array([0]), np.array([0, 2, 3]), np.array([1, 2, 3]), np.array([6, 6, 6]))
    assert [x.tolist() for x in places] == [[0, 0], [1, 4], [6, 6]]


def test_near_passage_beside_other_shared_words_is_found():
    """A stray shared phrase, or a heavily edited part, behind a near passage does not hide it."""
    rng = np.random.default_rng(14)

    def shingled(words):
        return np.array([hash(tuple(words[i : i + 5])) & 0xFFFFFFFF for i in range(len(words) - 4)], dtype=np.uint32)

    for trial in range(60):
        fresh = itertools.count(1000 * trial)
        take = lambda n: [next(fresh) for _ in range(n)]
        part, at = take(52), int(rng.integers(5, 47))
        phrases = [take(8) for _ in range(1 if trial % 2 else 6)]
        a = take(20) + part + [w for p in phrases for w in take(4) + p] + take(20)
        b = take(33) + part[:at] + take(1) + part[at + 1 :] + [w for p in phrases for w in take(4) + p] + take(20)
        found = substring_dedup.similar_passages(shingled(a), shingled(b), [20 - 33], 50, 80)
        assert any(p[0] <= 21 and p[1] >= 71 and p[2] <= 34 and p[3] >= 84 and p[4] >= 0.8 for p in found)


def test_compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(1)
    for _ in range(100):
        ends = np.cumsum(rng.integers(0, 60, 4))
        starts = np.concatenate([[0], ends[:-1]])
        v = rng.integers(0, 1 << 62, ends[-1]).astype(np.uint64)
        expected = set()

        def tree(left, right):
            if right - left + 1 >= 7:
                c = left + int(v[left : right + 1].argmin())
                expected.add((left, c, right))
                tree(left, c - 1)
                tree(c + 1, right)

        for a, b in zip(starts, ends):
            tree(a, b - 1)
        assert set(map(tuple, np.column_stack(substring_dedup.compact_windows(v, starts, ends, 7)).tolist())) == expected


# Licences

def test_notices_are_named_and_prose_is_not(spark, docs, empty):
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "All rights reserved."]
    rng = random.Random(8)
    rows = [(i, prose(rng, 40) + "\n" + (notices[i % 8] if i % 8 < 4 else "The license of the house, released from all rights.") + "\n" + prose(rng, 20)) for i in range(80)]
    rows += [(None, notices[0]), (100, None), (101, ""), (102, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit("f")).repartition(3)
    got = {(r.doc_id, r.paragraph, r.family) for r in license_scan.licence_paragraphs(table).filter("confirmed").collect()}
    names = ["Apache-2.0", "MIT", "CC-BY-NC", "Proprietary"]
    assert got == {(i, 1, names[i % 8]) for i in range(80) if i % 8 < 4} | {(None, 0, "Apache-2.0")}
    assert license_scan.licence_paragraphs(empty).count() == 0
    assert license_scan.licence_paragraphs(docs).filter("confirmed").count() == 0


def test_licence_features_and_levels_come_from_all_paragraphs(spark):
    """What only documents beyond any few hundred hold still counts."""
    rng = random.Random(21)
    ids = spark.range(700).orderBy(F.xxhash64("id"), "id")
    late = {r.id for r in ids.collect()[400:]}
    phrase = "provided that the following conditions are met"
    rows = [(i, prose(rng, 30) + "\n" + prose(rng, 12) + (f" {phrase} {prose(rng, 9)}" if i in late else "")) for i in range(700)]
    scanned = license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), license_scan.Limits())
    model = license_scan.trained(scanned)
    lines = [words(line) for _, text in rows for line in text.split("\n")]
    counts = Counter(g for line in lines for g in {f"{a} {b}" for a, b in zip(line, line[1:])})
    least = max(0.005 * len({tuple(line) for line in lines}), 8)
    assert counts["conditions are"] == len(late) > least
    assert not {"following conditions", "conditions are", "are met"} & set(model.features)
    assert set(model.features) >= {g for g in license_scan.listed_bigrams(spark, license_scan.Limits()) if counts[g] <= least}


def test_runs_from_matching_shingles_are_those_of_whole_diagonals(monkeypatch):
    rng = np.random.default_rng(6)
    for trial in range(300):
        equal = rng.random(rng.integers(1, 120)) < rng.choice([0.1, 0.5, 0.8, 0.95])
        dense = [(a, b, int(equal[a:b].sum())) for a, b in substring_dedup.best_runs(equal, 80)]
        assert substring_dedup.sparse_runs(np.flatnonzero(equal).tolist(), 80) == dense
    for trial in range(60):
        a, b = (rng.integers(0, rng.choice([3, 40]), rng.integers(5, 90)).astype(np.uint32) for _ in "ab")
        few = sorted(substring_dedup.all_runs(a, b, [0, 7], 80))
        with monkeypatch.context() as patched:
            patched.setattr(substring_dedup, "matches", lambda *args: None)
            assert sorted(substring_dedup.all_runs(a, b, [0, 7], 80)) == few
