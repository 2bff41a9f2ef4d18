"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by spark.checkpoint.dir.

    Only a local run without that setting gets a folder of its own.
    """
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="altigrid-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The written files cut the lineage, so a lost executor does not lead back
    to the input, and what was dealt out by chance (task numbers, sampled
    ranges) stays as it was.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame, *known: str) -> DataFrame:
    """df with all columns but the known ones under generated names; toDF(*df.columns) undoes it."""
    return df.toDF(*(c if c in known else f"_column_{i}" for i, c in enumerate(df.columns)))


def stored_place(df: DataFrame, *columns: str, name: str) -> DataFrame:
    """The named columns, and as `name` the row's place in the files that df was read from, in the order they were written.

    Rows that do not come from files have no such order: they get a number of the task's own.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("long")
    try:
        return df.select(*columns, (F.shiftleft(F.coalesce(part, F.lit(0)), 40) + F.col("_metadata.row_index")).alias(name))
    except AnalysisException:
        return df.select(*columns, F.monotonically_increasing_id().alias(name))


def discard(df: DataFrame) -> None:
    """Remove the files behind a table that saved() returned."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def wider(df: DataFrame, columns: dict[str, str]) -> StructType:
    """The schema of df with more columns."""
    more = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
    return StructType([*df.schema.fields, *more.fields])


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library


def release() -> None:
    """Hand back memory that this Python worker has freed: workers outlive their tasks, and it counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, clear: Callable[[], None]) -> None:
    """Tell that this Python worker's memory is for one operator's cache now; others are emptied."""
    others = [n for n in _HELD if n != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        release()
    _HELD[name] = clear


def small_batches(batches, column: str, most: int = 4_000_000):
    """Cut Arrow batches so that the texts of each have about `most` bytes.

    A single longer text is a batch of its own. Nothing is left out. After the last one, freed
    memory is handed back.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        bins = np.cumsum(lengths) // most
        cuts = np.flatnonzero(np.diff(bins)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)
    release()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each connected component: edges (a, b) -> (node, root).

    Every round takes the smallest label among neighbours, then the label of
    that label, so chains halve. Each round is written to the shared folder;
    nothing is gathered on the driver but whether a label has changed.
    """
    both = saved(
        edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"), F.lit(True).alias("moved")))
    while labels.where("moved").limit(1).count():
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("next"))
        done = lower.join(jump, "via", "left").select(
            "node", F.least("via", F.coalesce("next", "via")).alias("root"), (F.least("via", F.coalesce("next", "via")) < F.col("old")).alias("moved")
        )
        last, labels = labels, saved(done)
        discard(last)
    discard(both)
    return labels.select("node", "root")
