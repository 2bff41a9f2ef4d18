"""Roll-up of the finest pixels into all coarser zooms.

A pixel of zoom z covers the four pixels ``(2gx, 2gy) .. (2gx+1, 2gy+1)`` of
zoom z + 1, so all descendants of one coarsest pixel (its *block*, at most
``4 ** levels`` rows: about a million over ten levels) can be brought to one
place once and every level between computed there without another shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK_LEVELS = 10
# Finest pixels of a task, in which each becomes a row for every ancestor.
TASK_PIXELS = 250_000
# Levels reached directly from the finest pixels; a 16th of them is left above.
NEAR_LEVELS = 2

# Roll-up rules: measure columns of a pixel table and how four become one.
_MEASURES = {
    "max": {"alt": lambda: F.max("alt")},
    "mean": {"total": lambda: F.sum("total"), "n": lambda: F.sum("n")},
    "count": {"n": lambda: F.sum("n")},
}


def _rules(agg: str):
    if agg not in _MEASURES:
        raise ValueError(f"unknown roll-up {agg!r}")
    return _MEASURES[agg]


def _finish(levels: DataFrame, agg: str) -> DataFrame:
    if agg == "mean":
        levels = levels.withColumn("alt", F.expr("CAST(total DIV n AS INT)"))
    return levels


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks that keep each at about TASK_PIXELS of at most ``rows`` pixels; None for few, which the planner may place.

    The planner joins partitions by their bytes, and pixels are so short that tens of millions meet in one.
    """
    return max(-(-rows // TASK_PIXELS), spark.sparkContext.defaultParallelism) if rows > TASK_PIXELS else None


def by_block(pixels: DataFrame, levels: int, columns: list[str], tasks: int | None = None) -> DataFrame:
    """(block, gx, gy, columns): all pixels below one pixel ``levels`` up in one partition, of ``tasks``."""
    bx, by = (F.shiftright(g, levels).cast("bigint") for g in ("gx", "gy"))
    block = (F.shiftleft(by, 32) + bx).alias("block")
    return pixels.select(block, "gx", "gy", *columns).repartition(*[tasks] * (tasks is not None), "block")


def _ancestors(blocks: DataFrame, zoom: int, ups: range, rules: dict) -> DataFrame:
    """Pixels ``ups`` levels above those of ``zoom``, without leaving the block."""
    fanned = blocks.select("*", F.explode(F.lit(list(ups))).alias("up"))
    shifted = [F.call_function("shiftright", F.col(g), F.col("up")).alias(g) for g in ("gx", "gy")]
    rolled = fanned.groupBy("block", "up", *shifted).agg(*[f().alias(c) for c, f in rules.items()])
    return rolled.select((F.lit(zoom) - F.col("up")).alias("zoom"), "gx", "gy", *rules)


def pyramid(pixels: DataFrame, max_zoom: int, min_zoom: int = 0, agg: str = "max",
            tasks: int | None = None) -> DataFrame:
    """All zooms max_zoom..min_zoom, from one row per pixel of ``max_zoom``.

    ``agg``: ``max`` of ``alt``; ``mean`` of (total, n), exact at every zoom;
    ``count`` sums ``n``. The finest pixels are shuffled once, by block. In
    place, each then counts towards its next few ancestors, and the few pixels
    left at the top of those towards all others. ``tasks`` (see :func:`tasks_for`) is
    the number of partitions of that shuffle, else the planner's choice.
    """
    rules = _rules(agg)
    levels = max_zoom - min_zoom
    if levels > BLOCK_LEVELS:
        # A block stays within a million rows: do the finest levels first.
        cut = max_zoom - BLOCK_LEVELS
        fine = pyramid(pixels, max_zoom, cut, agg, tasks)
        coarse = pyramid(fine.where(F.col("zoom") == cut), cut, min_zoom, agg, tasks)
        return fine.unionByName(coarse.where(F.col("zoom") < cut))
    blocks = by_block(pixels, levels, list(rules), tasks)
    near = min(levels, NEAR_LEVELS)
    found = [blocks.select(F.lit(max_zoom).alias("zoom"), "gx", "gy", *rules)]
    if near:
        found.append(_ancestors(blocks, max_zoom, range(1, near + 1), rules))
    if levels > near:
        parents = [F.shiftright(g, near).alias(g) for g in ("gx", "gy")]
        top = blocks.groupBy("block", *parents).agg(*[f().alias(c) for c, f in rules.items()])
        found.append(_ancestors(top, max_zoom - near, range(1, levels - near + 1), rules))
    return _finish(reduce(DataFrame.unionByName, found), agg)


def roll_up(pixels: DataFrame, zoom: int, agg: str = "max") -> DataFrame:
    """One level: the pixels of ``zoom`` from those of ``zoom + 1``."""
    rules = _rules(agg)
    parents = [F.shiftright(g, 1).alias(g) for g in ("gx", "gy")]
    rolled = pixels.groupBy(*parents).agg(*[f().alias(c) for c, f in rules.items()])
    return _finish(rolled.select(F.lit(zoom).alias("zoom"), "*"), agg)


def pyramid_by_level(pixels: DataFrame, max_zoom: int, min_zoom: int = 0,
                     agg: str = "max") -> DataFrame:
    """The same zooms as :func:`pyramid`, each level from the one below it.

    Every level is one exchange that the union reads twice (its own output and
    the next level), which Spark plans as one reused exchange. Moves each level
    once more than :func:`pyramid` and runs one stage per level.
    """
    level = _finish(pixels.select("zoom", "gx", "gy", *_rules(agg)), agg)
    found = [level]
    for zoom in range(max_zoom - 1, min_zoom - 1, -1):
        level = roll_up(level, zoom, agg)
        found.append(level)
    return reduce(DataFrame.unionByName, found)


def pyramid_fanout(pixels: DataFrame, max_zoom: int, min_zoom: int = 0,
                   agg: str = "max", tasks: int | None = None) -> DataFrame:
    """The same zooms as :func:`pyramid`, each pixel sent to all its ancestors.

    Rows of every zoom cross one shuffle, combined in each task beforehand. With ``tasks``
    (see :func:`tasks_for`) the pixels are first dealt to so many, near ones together.
    """
    rules = _rules(agg)
    dealt = pixels if tasks is None else by_block(pixels, NEAR_LEVELS, list(rules), tasks)
    up = F.explode(F.sequence(F.lit(0), F.lit(max_zoom - min_zoom))).alias("up")
    fanned = dealt.select("gx", "gy", *rules, up)
    shifted = [F.call_function("shiftright", F.col(g), F.col("up")).alias(g) for g in ("gx", "gy")]
    rolled = fanned.groupBy((F.lit(max_zoom) - F.col("up")).alias("zoom"), *shifted).agg(
        *[f().alias(c) for c, f in rules.items()])
    return _finish(rolled, agg)


def pyramid_mean_of_means(cells: DataFrame, max_zoom: int, min_zoom: int = 0) -> DataFrame:
    """Each level the truncated mean of the truncated means below it.

    Differs from ``agg="mean"``, which weighs by the number of points. Each level
    is one exchange that its own output and the next level share, as in
    :func:`pyramid_by_level`.
    """
    level = cells.select("gx", "gy", "alt")
    found = [level]
    for _ in range(max_zoom - min_zoom):
        parents = [F.shiftright(g, 1).alias(g) for g in ("gx", "gy")]
        sums = level.groupBy(*parents).agg(F.sum("alt").alias("total"), F.count("alt").alias("n"))
        level = sums.select("gx", "gy", F.expr("CAST(total DIV n AS INT)").alias("alt"))
        found.append(level)
    zoomed = [df.select(F.lit(max_zoom - up).alias("zoom"), "gx", "gy", "alt")
              for up, df in enumerate(found)]
    return reduce(DataFrame.unionByName, zoomed)
