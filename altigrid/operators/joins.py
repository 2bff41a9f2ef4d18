"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 2_000_000


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
               hot_rows: int = HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Equi-join (inner, left or left_anti) of a left side with hot keys.

    Keys with more than ``hot_rows`` left rows are cut into pieces of about
    that size by a running number of the row, so that equal rows part too, and
    their right rows repeated once per piece; all other keys join as they are.
    The list of hot keys has at most rows / hot_rows entries; how it is joined is the
    planner's choice. The right side should hold few rows per key. ``counts``: left rows ``n``
    of each key, if they are known already.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    hot = (
        sizes.withColumnRenamed("n", "_n").where(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_pieces"))
    )
    numbered = left.withColumn("_row", F.monotonically_increasing_id())
    piece = F.pmod("_row", F.col("_pieces"))
    cut = numbered.join(hot, keys, "left").withColumn(
        "_piece", F.coalesce(piece, F.lit(0)).cast("int")).drop("_pieces", "_row")
    repeated = right.join(hot, keys, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_pieces")
    return cut.join(repeated, [*keys, "_piece"], how).drop("_piece")
