"""Session settings, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A join side within both bounds may be broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = own_folder()
    return f"{base.rstrip('/')}/variantloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each ends, not when the driver next collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write `df` once to shared storage and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what `written` wrote for `df`, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/variantloom/" not in folder:
            raise ValueError(f"{folder} is no scratch table")
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cell_bytes(cell: Column, kind: T.DataType) -> Column:
    """Rough size of a cell: text and binary by their bytes, nested cells by what they hold, others by 16."""
    base = F.lit(16).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return base + F.coalesce(F.octet_length(cell), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            sizes = F.transform(cell, lambda x: cell_bytes(x, kind.elementType))
            return base + F.coalesce(F.aggregate(sizes, base * 0, lambda total, x: total + x), F.lit(0))
        return base + F.coalesce(F.size(cell), F.lit(0)) * 16
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return cell_bytes(F.map_keys(cell), keys) + cell_bytes(F.map_values(cell), values)
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [cell_bytes(cell.getField(f.name), f.dataType) for f in kind.fields], base)
    if isinstance(kind, T.VariantType):
        return base + F.coalesce(F.octet_length(F.to_json(cell)), F.lit(0))
    return base


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row."""
    cells = [cell_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, cells, F.lit(0).cast("bigint"))


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether `df` is proven small. Runs one job that stops after `max_rows + 1` rows per task."""
    if max_rows <= 0:
        return False
    sizes = df.select(row_bytes(df).alias("bytes")).limit(max_rows + 1)
    total = sizes.agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")).first()
    return total["rows"] <= max_rows and (total["bytes"] or 0) <= max_bytes


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if a bounded check proves it small; else for a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df.hint("merge")
