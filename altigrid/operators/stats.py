"""Summary statistics and histograms of one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# 100 edges, 80 apart from 0; the last bucket ends at 7920.
DEFAULT_EDGES = [i * (8000.0 / 100) for i in range(100)]
DEFAULT_BUCKETS = 100


def summary_stats(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, population standard deviation, max and min."""
    value = F.col(col)
    return df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stdev"),
        F.max(value).alias("max"), F.min(value).alias("min"))


def _bucket(value: Column, edges: Sequence[float]) -> Column:
    """Index of the edge at or below the value; the caller checks the range."""
    first, step, last = edges[0], edges[1] - edges[0], len(edges) - 2
    if all(e == first + i * step for i, e in enumerate(edges)):
        guess = F.floor((value - F.lit(first)) / F.lit(step))
        # Division may round across an edge; the edges themselves decide.
        low = F.lit(first) + guess * F.lit(step)
        fixed = guess - (value < low).cast("int") + (value >= low + F.lit(step)).cast("int")
        return F.least(fixed, F.lit(last)).cast("int")

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(value < F.lit(edges[mid]), search(lo, mid - 1)).otherwise(search(mid, hi))

    return search(0, last)


def _dense(counts: DataFrame, buckets: int) -> DataFrame:
    """Sum (bucket, n) per bucket, with a row for buckets that have none."""
    every = counts.sparkSession.range(0, buckets, 1, 1).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    return counts.unionByName(every).groupBy("bucket").agg(F.sum("n").alias("n"))


def histogram_edges(df: DataFrame, col: str, edges: Sequence[float] = DEFAULT_EDGES) -> DataFrame:
    """Counts between given edges: (bucket, low, high, n).

    Buckets are closed on the left, the last one on both sides; values outside
    the edges are not counted.
    """
    edges = [float(e) for e in edges]
    if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be at least two increasing numbers")
    value = F.col(col).cast("double")
    inside = df.where((value >= F.lit(edges[0])) & (value <= F.lit(edges[-1])))
    counts = inside.groupBy(_bucket(value, edges).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    at = F.array(*[F.lit(e) for e in edges])
    return _dense(counts, len(edges) - 1).select(
        "bucket", F.get(at, F.col("bucket")).alias("low"),
        F.get(at, F.col("bucket") + 1).alias("high"), "n")


def histogram_auto(df: DataFrame, col: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Counts in equal buckets between the smallest and the largest value.

    Small whole numbers are first counted by value; the range and the buckets
    then both come from those few counts, so the table is read once. Other
    types may have as many values as rows: they are read twice, for the range
    and for the buckets, and never shuffled by value.
    """
    value = F.col(col).cast("double").alias("v")
    rows = df.select(value).where(F.abs("v") < F.lit(float("inf")))  # finite ones only
    if df.schema[col].dataType.typeName() in ("byte", "short", "integer"):
        rows = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    else:
        rows = rows.withColumn("n", F.lit(1).cast("bigint"))
    # Summing n keeps both uses of the counts identical, so their exchange is shared.
    span = rows.agg(
        F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("n"))).scalar()
    lo, hi = span["lo"], span["hi"]
    share = F.floor((F.col("v") - lo) * F.lit(float(buckets)) / F.nullif(hi - lo, F.lit(0.0)))
    bucket = F.when(share.isNull(), 0).otherwise(F.least(share, F.lit(buckets - 1))).cast("int")
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    edge = lambda i: lo + i.cast("double") * (hi - lo) / F.lit(float(buckets))
    return _dense(counts, buckets).select(
        "bucket", edge(F.col("bucket")).alias("low"), edge(F.col("bucket") + 1).alias("high"), "n")
