"""Whole jobs from files to tables, as a user submits them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from altigrid.functions import grid
from altigrid.functions.grid import MAX_ZOOM
from altigrid.operators import gps, pixels, places, pyramid, rasters, serving, stats, tiles
from altigrid.sources import hgt, places as place_files, points, store, tile_table


def read_elevation(spark: SparkSession, path: str, kind: str, mode: str = points.STRICT) -> DataFrame:
    """Bounded points of text (``lat,lng,height``) or binary elevation files."""
    if kind == "text":
        found = points.parse_dem(points.read_lines(spark, path), mode)
    elif kind == "hgt":
        found = hgt.read_hgt(spark, path, mode=mode)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return points.dem_bounds(found, mode)


def build_tiles(spark: SparkSession, readings: DataFrame, out: str, max_zoom: int = MAX_ZOOM,
                min_zoom: int = 0) -> None:
    """Bounded points to ``out/pixels`` (long form) and ``out/tiles`` (rasters).

    The readings are scanned once. The pixel table is written before tiles are
    packed from it, so a lost executor never sends the job back to the readings
    and the key ranges of the tile table are sampled from stored pixels.
    """
    finest = pixels.pixel_max(readings, max_zoom)
    store.write_pixels(pyramid.pyramid(finest, max_zoom, min_zoom), f"{out}/pixels")
    packed = tiles.pack_tiles(store.read_pixels(spark, f"{out}/pixels"), ranged=True)
    store.write_sorted_tiles(packed, f"{out}/tiles")


def build_tile_table(spark: SparkSession, readings: DataFrame, path: str, max_zoom: int = MAX_ZOOM, min_zoom: int = 0) -> None:
    """Bounded points to a tile table that later runs can update, without a table of pixels.

    The finest pixels are packed and written; coarser zooms come from the stored rasters.
    """
    tile_table.build_tile_table(spark, tile_table.finest_tiles(readings, max_zoom), path, max_zoom, min_zoom)


def update_tile_table(spark: SparkSession, readings: DataFrame, path: str, max_zoom: int = MAX_ZOOM, min_zoom: int = 0) -> None:
    """Put bounded points into a stored tile table; only key ranges that they touch are rewritten."""
    tile_table.update_tile_table(spark, tile_table.finest_tiles(readings, max_zoom), path, max_zoom, min_zoom)


def render(spark: SparkSession, path: str, out: str, palette: str) -> None:
    """Stored tiles as RGBA rasters, under the same keys."""
    coloured = rasters.tile_rgba_stored(tile_table.read_tile_table(spark, path), palette)
    coloured.write.mode("overwrite").partitionBy("zoom").parquet(out)


def upsert_points(spark: SparkSession, path: str, out: str) -> None:
    """Points of a text file put into the point table ``out``, which is created if it is not there.

    Of lines with one key the greatest as text wins; failed lines and points off the map are left out.
    """
    found = points.gps_bounds(points.parse_points_rowfail(points.read_lines(spark, path)).where("ok"))
    updates = gps.points_upsert(found, "line")
    if store.exists(spark, out):
        tile_table.upsert_point_table(spark, updates, out)
    else:
        tile_table.write_point_table(updates, out)


def elevation_stats(spark: SparkSession, path: str, out: str, mode: str = points.STRICT,
                    fraction: float = 0.01) -> None:
    """Statistics of all heights and of a sample, and both histograms."""
    _column_stats(points.parse_dem(points.read_lines(spark, path), mode), "height", out, fraction)


def gps_stats(spark: SparkSession, path: str, out: str, mode: str = points.STRICT,
              fraction: float = 0.01) -> None:
    """The same of all longitudes."""
    _column_stats(points.parse_gps(points.read_lines(spark, path), mode), "lon", out, fraction)


def _column_stats(parsed: DataFrame, col: str, out: str, fraction: float) -> None:
    """The text is parsed once, into ``out/values``; all results read that column."""
    parsed.select(col).write.mode("overwrite").parquet(f"{out}/values")
    df = parsed.sparkSession.read.schema(parsed.select(col).schema).parquet(f"{out}/values")
    results = {
        "summary": stats.summary_stats(df, col),
        "summary_sample": stats.summary_stats(gps.sample_bernoulli(df, fraction), col),
        "histogram_edges": stats.histogram_edges(df, col).orderBy("bucket"),
        "histogram_auto": stats.histogram_auto(df, col).orderBy("bucket"),
    }
    for name, result in results.items():
        result.write.mode("overwrite").option("header", "true").csv(f"{out}/{name}")


def gps_visits(spark: SparkSession, path: str, out: str, zoom: int, mode: str = points.STRICT) -> None:
    """Visits, centroid and heat per pixel, as text and as a table."""
    found = points.gps_bounds(points.parse_gps(points.read_lines(spark, path), mode), mode)
    gps.gps_pixels(found, zoom).write.mode("overwrite").parquet(f"{out}/visits")
    visits = spark.read.parquet(f"{out}/visits")
    gps.heat_of(visits).write.mode("overwrite").parquet(f"{out}/heat")
    lines = visits.select(F.concat_ws(",", "zoom", "gx", "gy", "n", "lat", "lon").alias("line"))
    store.write_lines(lines, f"{out}/text")


def store_points(spark: SparkSession, path: str, out: str, fraction: float | None = None,
                 mode: str = points.STRICT) -> None:
    """Points under their geohash; all lines that do not parse go to ``out/failed``.

    ``fraction`` stores a sample of the points only. strict leaves out failed
    lines and points off the map; compat stores failed lines as (0, 0). Of lines
    with one key the greatest as text wins, whatever order tasks run in. The text
    is scanned and parsed once, into ``out/parsed``, with failed lines apart.
    """
    parsed = points.parse_points_rowfail(points.read_lines(spark, path))
    parsed.write.mode("overwrite").partitionBy("ok").parquet(f"{out}/parsed")
    found = spark.read.schema(parsed.schema).parquet(f"{out}/parsed")
    store.write_lines(points.failed_lines(found), f"{out}/failed")
    kept = points.gps_bounds(found.where("ok") if mode == points.STRICT else found, mode)
    if fraction is not None:
        kept = gps.sample_bernoulli(kept, fraction, seed=0)
    gps.points_upsert(kept, "line").write.mode("overwrite").parquet(f"{out}/points")


def store_cities(spark: SparkSession, cities: str, regions: str, out: str) -> None:
    """Cities with their region, one per geohash, in key order: rows and cells."""
    joined = places.join_regions(
        place_files.parse_cities(points.read_lines(spark, cities)),
        place_files.parse_regions(points.read_lines(spark, regions)))
    keyed = places.city_by_geohash(joined)
    ordered = keyed.repartitionByRange("geohash").sortWithinPartitions("geohash")
    ordered.write.mode("overwrite").parquet(f"{out}/cities")
    places.city_cells(spark.read.parquet(f"{out}/cities")).write.mode("overwrite").parquet(f"{out}/cells")


def hgt_to_text(spark: SparkSession, path: str, out: str, mode: str = points.STRICT,
                drop_shared_edge: bool = False) -> None:
    """Binary elevation files to ``lat,lng,height`` text, voids left out.

    ``drop_shared_edge`` leaves out the row and column that the next file repeats.
    """
    found = hgt.read_hgt(spark, path, mode=mode, min_height=None, drop_shared_edge=drop_shared_edge)
    store.write_lines(hgt.points_to_text(found), out)


def serve(spark: SparkSession, tiles_path: str, requests: str, out: str, kind: str, banded: bool = False) -> None:
    """Answers to a table of requests from a stored tile table: ``out/<kind>``.

    lookup: (lat, lon, zoom); box: (lat_min, lon_min, lat_max, lon_max, zoom);
    missing: (zoom, tile_x, tile_y), answered with those that are not stored;
    key: (zoom, geohash). Other columns of the requests are kept. ``banded`` reads a
    tile table: box and lookup then read only the key intervals that the requests name.
    """
    asked = spark.read.parquet(requests)
    stored = tile_table.read_tile_table(spark, tiles_path) if banded else store.read_tiles(spark, tiles_path)
    if banded and kind in ("lookup", "box"):
        x, y = grid.tile_index(F.col("lat"), F.col("lon"), F.col("zoom"))
        found = tile_table.tiles_in_boxes(asked, stored) if kind == "box" else tile_table.lookup_tiles(
            asked.withColumn("tile_x", x).withColumn("tile_y", y), stored)
        found.write.mode("overwrite").parquet(f"{out}/{kind}")
        return
    stored = stored.drop("code", "band")
    answers = {
        "lookup": lambda: serving.tile_lookup(asked, stored),
        "box": lambda: serving.tiles_in_bbox(asked, stored),
        "missing": lambda: serving.viewport_missing(asked, stored),
        "key": lambda: serving.key_lookup(asked, stored),
    }
    if kind not in answers:
        raise ValueError(f"unknown kind of request {kind!r}")
    answers[kind]().write.mode("overwrite").parquet(f"{out}/{kind}")
