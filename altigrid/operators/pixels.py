"""Points to pixels: assignment and per-pixel aggregates.

Aggregates group on the two integer pixel indices only, so that Spark combines
points inside each task before the one shuffle; everything else about a pixel
(tile, place in the tile) is derived afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from altigrid.functions import grid
from altigrid.functions.grid import MAX_ZOOM


def zoom_grid(spark: SparkSession, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Rows, columns and angular step of zooms 0..max_zoom."""
    zoom = F.col("zoom")
    return spark.range(max_zoom + 1).select(F.col("id").cast("int").alias("zoom")).select(
        "zoom",
        grid.grid_rows(zoom).alias("n_rows"),
        grid.grid_cols(zoom).alias("n_cols"),
        grid.step_degrees(zoom).alias("step"),
    )


def with_tile(pixels: DataFrame) -> DataFrame:
    """Replace the map-wide index (gx, gy) by tile and place in the tile."""
    gx, gy = F.col("gx"), F.col("gy")
    rest = [c for c in pixels.columns if c not in ("zoom", "gx", "gy")]
    return pixels.select(
        "zoom",
        grid.tile_of(gx).alias("tile_x"), grid.tile_of(gy).alias("tile_y"),
        grid.local_of(gx).alias("x"), grid.local_of(gy).alias("y"),
        *rest,
    )


def assign_pixels(points: DataFrame, zoom: int) -> DataFrame:
    """Add zoom, gx, gy to points inside the map bounds."""
    gx, gy = grid.pixel_index(F.col("lat"), F.col("lon"), zoom)
    return points.select("*", F.lit(zoom).alias("zoom"), gx.alias("gx"), gy.alias("gy"))


def _group(points: DataFrame, zoom: int, *measures) -> DataFrame:
    pixels = assign_pixels(points, zoom).groupBy("gx", "gy").agg(*measures)
    return pixels.select(F.lit(zoom).alias("zoom"), "*")


def pixel_max(points: DataFrame, zoom: int) -> DataFrame:
    """Highest altitude per pixel: (zoom, gx, gy, alt)."""
    return _group(points, zoom, F.max("height").alias("alt"))


def pixel_argmax(points: DataFrame, zoom: int) -> DataFrame:
    """The highest point per pixel; ties go to the lowest lat, then the lowest lon."""
    place = F.struct("lat", "lon", "height")
    rank = F.struct("height", -F.col("lat"), -F.col("lon"))
    best = _group(points, zoom, F.max_by(place, rank).alias("best"))
    return best.select("zoom", "gx", "gy", "best.lat", "best.lon", "best.height")


def pixel_mean(points: DataFrame, zoom: int) -> DataFrame:
    """Sum and count of altitudes per pixel, with their truncated mean ``alt``."""
    sums = _group(points, zoom, F.sum("height").alias("total"), F.count("height").alias("n"))
    return sums.withColumn("alt", F.expr("CAST(total DIV n AS INT)"))


def cell_mean(points: DataFrame, zoom: int) -> DataFrame:
    """Truncated mean altitude per cell of one angular step (gx, gy count cells).

    ``total`` and ``n`` stay beside it for exact roll-ups.
    """
    gx, gy = grid.tile_index(F.col("lat"), F.col("lon"), zoom)
    return (
        points.groupBy(gx.alias("gx"), gy.alias("gy"))
        .agg(F.sum("height").alias("total"), F.count("height").alias("n"))
        .select(F.lit(zoom).alias("zoom"), "*", F.expr("CAST(total DIV n AS INT)").alias("alt"))
    )


def pixels_all_zooms(points: DataFrame, max_zoom: int = MAX_ZOOM, min_zoom: int = 0,
                     tasks: int | None = None) -> DataFrame:
    """Highest altitude per pixel at every zoom.

    Points are first reduced to the finest pixels; only these fan out, one row
    per zoom: the cross-check of the roll-ups in ``pyramid``. ``tasks``: into how many
    tasks the finest pixels are dealt before, else the planner's choice.
    """
    up = F.explode(F.sequence(F.lit(0), F.lit(max_zoom - min_zoom))).alias("up")
    finest = pixel_max(points, max_zoom).select("gx", "gy", "alt")
    if tasks is not None:
        finest = finest.repartition(tasks, F.shiftright("gx", 2), F.shiftright("gy", 2))
    fanned = finest.select("gx", "gy", "alt", up)
    gx, gy = (F.call_function("shiftright", F.col(g), F.col("up")).alias(g) for g in ("gx", "gy"))
    return fanned.groupBy((F.lit(max_zoom) - F.col("up")).alias("zoom"), gx, gy).agg(F.max("alt").alias("alt"))


def pixel_extent(points: DataFrame) -> DataFrame:
    """Extent of a point set: bounds, width, height in degrees, number of points."""
    bounds = points.agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.count(F.lit(1)).alias("n_points"),
    )
    return bounds.select(
        "*",
        (F.col("lon_max") - F.col("lon_min")).alias("width_deg"),
        (F.col("lat_max") - F.col("lat_min")).alias("height_deg"),
    )
