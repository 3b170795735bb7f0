"""A cohort store kept up to date from a watched folder, with the state of every sample in the stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from variantloom.functions import labels as L
from variantloom.operators.flatten import Ranks
from variantloom.plans.cohort_store import ingest_chosen
from variantloom.session import written
from variantloom.sources.vcf import Header, leading_lines

# Tasks get these helpers with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "path string, modificationTime timestamp, length long, content binary"
DECISION = "SAMPLE string, BASE string, path string, replaced string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SampleState(StatefulProcessor):
    """Per base name: the sample that counts, whether it is a processed one, and the files seen."""

    def __init__(self, suffix: str) -> None:
        self.suffix = suffix

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "SAMPLE string, path string, processed boolean")
        self.seen = handle.getMapState("seen", "path string", "superseded boolean")

    def is_processed(self, sample: str) -> bool:
        return bool(self.suffix) and self.suffix in sample

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        files = [(row.SAMPLE, row.path) for part in rows for row in part.itertuples(index=False)]
        fresh = [f for f in files if not self.seen.containsKey((f[1],))]
        for _, path in fresh:
            self.seen.updateValue((path,), (True,))
        if not fresh:
            return
        sample, path = min(fresh, key=lambda f: (not self.is_processed(f[0]), f[1], f[0]))
        held = self.current.get() if self.current.exists() else None
        if held is not None and (held[2] or not self.is_processed(sample)):
            return
        self.seen.updateValue((path,), (False,))
        if held is not None:
            self.seen.updateValue((held[1],), (True,))
        self.current.update((sample, path, self.is_processed(sample)))
        yield pd.DataFrame({"SAMPLE": [sample], "BASE": [key[0]], "path": [path], "replaced": [held[0] if held is not None else None]})

    def close(self) -> None:
        pass


def named_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The column line of each listed file."""
    for batch in batches:
        lines = pd.concat(list(leading_lines([batch.rename(columns={"path": "file"})])), ignore_index=True)
        last = lines[lines["line"].str.startswith("#CHROM")].drop_duplicates("file")
        yield batch.merge(last.rename(columns={"file": "path"}), on="path", how="left")


def stream_samples(
    spark: SparkSession,
    folder: str,
    store: str,
    checkpoint: str,
    suffix: str,
    header: Header | None = None,
    prioritized: bool | Ranks = True,
    files_per_batch: int = 1000,
    glob: str = "*.vcf*",
    name: str = "stream",
) -> StreamingQuery:
    """Take in the files that arrived since the last run, then stop (trigger availableNow).

    The stream carries file names; each file's sample is read from its header. State is kept by base name: which sample
    counts, and which files were seen. A processed sample that comes after the raw one replaces it. Every
    batch is committed to the store under its own number, so a batch that runs again changes nothing.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path")
    )
    lines = files.mapInPandas(named_files, "path string, line string")
    told = F.coalesce(F.get(F.split("line", "\t"), F.lit(9)), F.element_at(F.split("path", "/"), -1))
    offered = lines.select("path", told.alias("SAMPLE")).withColumn("BASE", L.sample_base(F.col("SAMPLE"), suffix))
    decisions = offered.groupBy("BASE").transformWithStateInPandas(SampleState(suffix), DECISION, "append", "none")

    def ingest(batch: DataFrame, batch_id: int) -> None:
        chosen = written(batch, "chosen")
        ingest_chosen(batch.sparkSession, store, f"{name}-{batch_id:09d}", chosen, prioritized, header)

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return (
            decisions.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PROVIDER, before)
