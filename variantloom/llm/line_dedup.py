"""Line deduplication across documents by sorted line hashes.

Hashes of long lines are range-partitioned by hash and document and sorted by hash, document and
place. A stream over each range counts the documents of every hash and finds the one that keeps its
lines; a hash that spans ranges gives one row in each, so a line in a third of all documents is
spread over many tasks. Documents get compressed bitmaps of the lines to keep; texts are not moved.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm import text as T
from variantloom.session import small_side, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def line_key(line: Column) -> Column:
    """What makes lines equal: blanks stripped at both ends, A-Z in lower case."""
    return T.lower_ascii(F.btrim(line, F.lit(T.BLANKS)))


def text_id(text: Column) -> Column:
    """Tells the texts of rows with one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def long_lines(docs: DataFrame, least: int) -> DataFrame:
    """h1, h2, doc_id, text_id, place, n_lines: a row for each line whose key has `least` code points."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = docs.select("doc_id", text_id(F.col("text")).alias("text_id"), F.size(lines).alias("n_lines"), F.posexplode(lines).alias("place", "line"))
    rows = rows.select("doc_id", "text_id", "n_lines", "place", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= least)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc_id", "text_id", "place", "n_lines")


def hash_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h1, h2, docs, keeper of each run of equal hashes in a sorted range; the largest doc_id comes first.

    Holds one batch and the open run: a run of any length streams through.
    """
    names = ["h1", "h2", "docs", "keeper"]
    held = None  # h1, h2, docs, keeper, last doc_id
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        doc = batch.column("doc_id").fill_null(0).to_numpy()
        new_hash = np.ones(n, dtype=bool)
        new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_hash.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (known[1:] != known[:-1])
        if held and held[0] == h1[0] and held[1] == h2[0]:
            new_hash[0] = False
            new_doc[0] = held[4] != (doc[0], known[0])
        starts = np.flatnonzero(new_hash)
        out: list[list] = [[], [], [], []]
        if not new_hash[0]:
            held = (held[0], held[1], held[2] + int(new_doc[: starts[0] if len(starts) else n].sum()), held[3], None)
        edges = np.append(starts, n)
        for a, b in zip(edges[:-1], edges[1:]):
            if held:
                for column, value in zip(out, held):
                    column.append(value)
            held = (int(h1[a]), int(h2[a]), int(new_doc[a:b].sum()), int(doc[a]) if known[a] else None, None)
        held = (*held[:4], (doc[-1], known[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in held[:4]], names=names)


def keep_bitmaps(docs: DataFrame, least: int = 40, docs_needed: int = 5) -> DataFrame:
    """doc_id, text_id, n_lines, n_dropped, bitmap for every text that loses lines.

    A line goes if its key has at least `least` code points and lies in at least `docs_needed`
    documents, unless its document has the largest doc_id among them. The bitmap is zlib over one bit
    per line, 1 to keep. Rows with one doc_id are one document; those without doc_id count as one,
    smaller than any other. NULL and empty texts have one empty line and lose nothing. Other columns
    are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    lines = written(long_lines(texts, least), "lines")
    ordered = lines.select("h1", "h2", "doc_id", "place").repartitionByRange(
        max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "h1", "h2", F.col("doc_id").desc_nulls_last()
    ).sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "place")
    runs = ordered.select("h1", "h2", "doc_id").mapInArrow(hash_runs, "h1 bigint, h2 bigint, docs bigint, keeper bigint")
    common = runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper")).filter(F.col("docs") >= docs_needed)
    common = written(common, "common")
    dropped = lines.join(small_side(common), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    places = dropped.groupBy("doc_id", "text_id", "n_lines").agg(F.collect_set("place").alias("places"))
    return places.mapInArrow(bitmaps, "doc_id bigint, text_id bigint, n_lines int, n_dropped int, bitmap binary")


def bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places to drop as compressed bitmaps of what stays."""
    for batch in batches:
        out, dropped = [], []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places")):
            keep = np.ones(n, dtype=bool)
            keep[places.values.to_numpy()] = False
            out.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            dropped.append(len(places.values))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_id"), batch.column("n_lines"), pa.array(dropped, pa.int32()), pa.array(out, pa.binary())],
            names=["doc_id", "text_id", "n_lines", "n_dropped", "bitmap"],
        )


def kept_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines that their bitmaps leave out."""
    for batch in batches:
        texts = []
        for text, n, packed in zip(batch.column("text").to_pylist(), batch.column("n_lines").to_pylist(), batch.column("bitmap").to_pylist()):
            keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=n)
            texts.append("\n".join(line for line, k in zip(text.split("\n"), keep) if k))
        arrays = [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("n_lines"), batch.column("n_dropped")]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "n_lines", "n_dropped"])


def deduplicated(docs: DataFrame, least: int = 40, docs_needed: int = 5) -> DataFrame:
    """doc_id, text without its dropped lines, n_lines (before), n_dropped: one row per input row."""
    T.small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    maps = written(keep_bitmaps(texts, least, docs_needed), "bitmaps").withColumnRenamed("n_lines", "_n")
    left = texts.withColumn("text_id", text_id(F.col("text"))).alias("l")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_id") == F.col("r.text_id"))
    joined = left.join(small_side(maps).alias("r"), same, "left").select(
        "l.doc_id", "l.text", F.size(F.split("l.text", "\n", -1)).alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "bitmap"
    )
    return joined.mapInArrow(whole_or_kept, "doc_id bigint, text string, n_lines int, n_dropped int")


def whole_or_kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a bitmap pass as they are."""
    names = ["doc_id", "text", "n_lines", "n_dropped"]
    for batch in batches:
        changed = batch.column("bitmap").is_valid()
        whole = batch.filter(pc.invert(changed))
        yield pa.RecordBatch.from_arrays([whole.column(c) for c in names], names=names)
        yield from kept_texts([batch.filter(changed)])
