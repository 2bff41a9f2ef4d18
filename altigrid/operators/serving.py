"""Reading the tile table: look-ups, boxes, views, key search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from altigrid.functions import grid
from altigrid.functions.grid import LAT_MIN, LON_MAX, LON_MIN, TILE_SIDE, ZOOM_LIMIT, clamp
from altigrid.operators.joins import split_join

TILE_KEY = ["zoom", "tile_x", "tile_y"]
SEARCH_LIMIT = 1000
HOT_TILES = 200


def view_zoom(span: Column, width_px: Column, max_zoom: int = ZOOM_LIMIT) -> Column:
    """Coarsest zoom whose pixels are no larger than the view's, at most max_zoom."""
    per_pixel = span / width_px
    fine = [F.when(F.lit(180.0 / (TILE_SIDE << z)) <= per_pixel, z) for z in range(max_zoom)]
    return F.coalesce(*fine, F.lit(max_zoom))


def view_span() -> Column:
    """Degrees that decide a view's zoom: the wider of both sides, so that a tall view has no more tiles.

    A view whose lon_min exceeds its lon_max goes over the date line.
    """
    wide = F.col("lon_max") - F.col("lon_min")
    return F.greatest(F.when(wide < 0, wide + F.lit(360.0)).otherwise(wide), F.col("lat_max") - F.col("lat_min"))


def _cover(low: Column, high: Column, origin: float, zoom: Column, count: Column):
    """First and last tile index that an interval of degrees overlaps.

    An interval of no width on a tile edge lies in the tile that begins there, on
    the edge of the map in the last one.
    """
    at = lambda deg: (deg - F.lit(origin)) / grid.step_degrees(zoom)
    first = F.greatest(F.floor(at(low)), F.lit(0))
    first = F.when((low == high) & (first == count), count - 1).otherwise(first)
    last = F.least(F.greatest(F.ceil(at(high)) - 1, F.when(low == high, F.floor(at(low)))), count - 1)
    return first.cast("int"), last.cast("int")


def _edges(boxes: DataFrame) -> DataFrame:
    """Boxes with the first and last tile indices _x0, _x1, _y0, _y1.

    A box whose lon_min exceeds its lon_max crosses the date line and becomes two.
    """
    zoom, low, high = F.col("zoom"), F.col("lon_min"), F.col("lon_max")
    span = lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"))
    sides = F.when(low > high, F.array(span(low, F.lit(LON_MAX)), span(F.lit(LON_MIN), high))).otherwise(F.array(span(low, high)))
    cut = boxes.withColumn("_lon", F.explode(sides))
    x0, x1 = _cover(F.col("_lon.a"), F.col("_lon.b"), LON_MIN, zoom, grid.grid_cols(zoom))
    y0, y1 = _cover(F.col("lat_min"), F.col("lat_max"), LAT_MIN, zoom, grid.grid_rows(zoom))
    return cut.select("*", x0.alias("_x0"), x1.alias("_x1"), y0.alias("_y0"), y1.alias("_y1")).drop("_lon")


def box_tiles(boxes: DataFrame) -> DataFrame:
    """One row per tile of a box (lat_min, lon_min, lat_max, lon_max, zoom).

    Adds tile_x, tile_y; boxes that touch no tile vanish. All other columns are
    kept.
    """
    edges = _edges(boxes)
    # An empty interval is a null list, which explodes to no row. Kept out of a
    # filter: that would be pushed below and repeat the arithmetic per bound.
    span = lambda a, b: F.explode(F.when(F.col(a) <= F.col(b), F.sequence(a, b)))
    return (
        edges.withColumn("tile_x", span("_x0", "_x1"))
        .withColumn("tile_y", span("_y0", "_y1"))
        .drop("_x0", "_x1", "_y0", "_y1")
    )


def viewport_cover(views: DataFrame, max_zoom: int = ZOOM_LIMIT) -> DataFrame:
    """Tiles that each view needs: zoom by degrees per pixel, then its cover.

    Input: lat_min, lon_min, lat_max, lon_max, width_px and the view's own
    columns; output: those other columns, zoom, tile_x, tile_y.
    """
    cover = box_tiles(views.withColumn("zoom", view_zoom(view_span(), F.col("width_px"), max_zoom)))
    return cover.drop("lat_min", "lon_min", "lat_max", "lon_max", "width_px")


def tiles_in_bbox(requests: DataFrame, tiles: DataFrame) -> DataFrame:
    """Stored tiles in each request's box at its zoom.

    A box becomes at most 64 square blocks of tiles, whatever its size. They meet
    the blocks of the stored tiles in one equi-join, so that rows follow what is
    stored and not the area. A stored tile stands for one block of each size that
    some request of its zoom has, mostly one or two. The join is an inner one of
    two shuffled sides: the adaptive planner splits blocks that many requests name. The
    hint is there because the planner takes the blocks to be as small as the requests they
    are exploded from, and would gather them on the driver for a broadcast.
    """
    needed = box_blocks(requests)
    # A map of at most 20 zooms to at most 20 sizes.
    of_zoom = needed.groupBy("zoom").agg(F.collect_set("_up").alias("sizes"))
    sizes = of_zoom.agg(F.map_from_entries(F.collect_list(F.struct("zoom", "sizes")))).scalar()
    shift = lambda c: F.call_function("shiftright", F.col(c), F.col("_up"))
    placed = tiles.withColumn("_up", F.explode(F.try_element_at(sizes, F.col("zoom"))))
    keys = placed.withColumns({"_bx": shift("tile_x"), "_by": shift("tile_y")})
    inside = F.col("tile_x").between(F.col("_x0"), F.col("_x1")) & F.col("tile_y").between(F.col("_y0"), F.col("_y1"))
    hits = needed.hint("merge").join(keys, ["zoom", "_up", "_bx", "_by"]).where(inside)
    return hits.drop("lat_min", "lon_min", "lat_max", "lon_max", "_up", "_bx", "_by", "_x0", "_x1", "_y0", "_y1")


def box_blocks(requests: DataFrame) -> DataFrame:
    """Requests with the blocks (_bx, _by) of 2 ** _up tiles a side that cover their box, 64 at most."""
    edges = _edges(requests)
    widest = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")) + 1
    up = F.greatest(F.lit(0), F.ceil(F.log2(widest / F.lit(7.0)))).cast("int")
    shift = lambda c: F.call_function("shiftright", F.col(c), F.col("_up"))
    span = lambda a, b: F.explode(F.when(F.col(a) <= F.col(b), F.sequence(shift(a), shift(b))))
    held = edges.withColumn("_up", F.coalesce(up, F.lit(0)))
    return held.withColumn("_bx", span("_x0", "_x1")).withColumn("_by", span("_y0", "_y1"))


def requested_tiles(requested: DataFrame, tiles: DataFrame, keys: list[str] = TILE_KEY) -> DataFrame:
    """Stored tiles that any request names; rasters of others go no further."""
    return tiles.join(requested.select(*keys).distinct(), keys, "left_semi")


def tile_lookup(requests: DataFrame, tiles: DataFrame) -> DataFrame:
    """The tile that holds each request's (lat, lon) at its zoom, null if none is stored."""
    tx, ty = grid.tile_index(F.col("lat"), F.col("lon"), F.col("zoom"))
    keyed = requests.withColumn("tile_x", tx).withColumn("tile_y", ty)
    return split_join(keyed, requested_tiles(keyed, tiles), TILE_KEY, "left")


def tile_by_key(tiles: DataFrame, zoom: int, geohash: str) -> DataFrame:
    """One tile by its key: the zoom prunes folders, the key reaches the scan."""
    return tiles.where((F.col("zoom") == zoom) & (F.col("geohash") == geohash))


def key_lookup(requests: DataFrame, tiles: DataFrame) -> DataFrame:
    """The tile stored under each request's (zoom, geohash), null if there is none."""
    keys = ["zoom", "geohash"]
    return split_join(requests, requested_tiles(requests, tiles, keys), keys, "left")


def viewport_missing(cover: DataFrame, have: DataFrame) -> DataFrame:
    """Tiles of a cover that are not among those at hand (by zoom and index)."""
    return split_join(cover, have.select(*TILE_KEY), TILE_KEY, "left_anti")


def tiles_visible(tiles: DataFrame, lat_min: float, lon_min: float, lat_max: float,
                  lon_max: float, zoom: int) -> DataFrame:
    """Tiles at or above a zoom that touch a rectangle, coarse ones first."""
    z, step = F.col("zoom"), grid.step_degrees(F.col("zoom"))
    south, west = grid.tile_lat(F.col("tile_y"), z), grid.tile_lon(F.col("tile_x"), z)
    touching = tiles.where(
        (z >= zoom)
        & (west <= lon_max) & (west + step >= lon_min)
        & (south <= lat_max) & (south + step >= lat_min))
    return touching.orderBy("zoom", "geohash")


def key_search(tiles: DataFrame, pattern: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """First hits of a case-insensitive pattern on the key, with the number of all hits."""
    hits = tiles.where(F.col("geohash").rlike(f"(?i){pattern}"))
    total = hits.agg(F.count(F.lit(1))).scalar()
    return hits.orderBy("geohash", "zoom").limit(limit).withColumn("n_hits", total)


def hot_tiles(requested: DataFrame, limit: int = HOT_TILES) -> DataFrame:
    """The most requested tiles."""
    counts = requested.groupBy(*TILE_KEY).agg(F.count(F.lit(1)).alias("n_requests"))
    return counts.orderBy(F.desc("n_requests"), *TILE_KEY).limit(limit)


def clamp_zoom(zoom: Column, low: int, high: int) -> Column:
    """A requested level held to the levels that exist."""
    return clamp(zoom, low, high)
