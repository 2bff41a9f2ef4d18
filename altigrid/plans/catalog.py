"""The registered queries: every operator over the whole derived inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from altigrid.functions import geohash as keys, grid
from altigrid.functions.palette import palette_from_object
from altigrid.operators import gps, pixels, places, pyramid, rasters, serving, stats, tiles
from altigrid.plans.views import Inputs
from altigrid.sources import hgt, places as place_files, points, store, tile_table

Query = Callable[[SparkSession, str], DataFrame]

MAX_ZOOM = 10       # pixel pyramids
MEAN_ZOOM = 8       # cell means
PIXEL_ZOOM = 3      # one-zoom pixel queries
TILE_ZOOM = 3       # packed rasters: random points leave no tile empty, each is 128 KiB
STORE_ZOOM = 6      # tile table without rasters
HGT_SIDE = 5        # grid side of the derived elevation files
SAMPLE = 0.01

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _round(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)


def _dem(i: Inputs) -> DataFrame:
    return points.dem_bounds(i.dem())


def _tasks(i: Inputs, name: str = "lineitem") -> int | None:
    """Tasks for the pixels of a table's readings, of which there are no more than its rows (counted from file footers)."""
    return pyramid.tasks_for(i.spark, i.table(name).count())


# --- parsing, filters -------------------------------------------------------

@_query
def parse_dem(i: Inputs) -> DataFrame:
    return points.parse_dem(i.dem_lines())


@_query
def parse_dem_compat(i: Inputs) -> DataFrame:
    return points.parse_dem(i.dem_lines(), points.COMPAT)


@_query
def parse_gps(i: Inputs) -> DataFrame:
    return points.parse_gps(i.gps_lines())


@_query
def parse_gps_compat(i: Inputs) -> DataFrame:
    return points.parse_gps(i.gps_lines(), points.COMPAT)


@_query
def parse_points_rowfail(i: Inputs) -> DataFrame:
    return points.parse_points_rowfail(i.gps_lines()).select("lat", "lon", "ok")


@_query
def points_failed_lines(i: Inputs) -> DataFrame:
    return points.failed_lines(points.parse_points_rowfail(i.gps_lines()))


@_query
def dem_bounds(i: Inputs) -> DataFrame:
    return points.dem_bounds(i.dem())


@_query
def gps_bounds(i: Inputs) -> DataFrame:
    return points.gps_bounds(i.gps())


@_query
def dem_positive(i: Inputs) -> DataFrame:
    return points.dem_positive(i.dem())


@_query
def dem_extent(i: Inputs) -> DataFrame:
    return pixels.pixel_extent(i.dem()).select(
        "lat_min", "lat_max", "lon_min", "lon_max", "n_points",
        _round("width_deg", 9), _round("height_deg", 9))


@_query
def scan_not_missing(i: Inputs) -> DataFrame:
    readings = points.parse_dem(i.dem_lines(), keep_bad=True)
    return places.scan_not_missing(readings, "height")


@_query
def sample_hash(i: Inputs) -> DataFrame:
    return gps.sample_hash(i.dem(), SAMPLE, "point_id")


@_query
def sample_bernoulli(i: Inputs) -> DataFrame:
    return gps.sample_bernoulli(i.dem(), SAMPLE, seed=7)


@_query
def sample_bernoulli_summary(i: Inputs) -> DataFrame:
    """Whether the draw is one: its share within six deviations, no strangers, no repeats.

    point_id is not unique: an id repeats if it is drawn more often than it occurs.
    """
    per_id = lambda df, name: df.groupBy("point_id").agg(F.count(F.lit(1)).alias(name))
    drawn = per_id(gps.sample_bernoulli(i.dem().select("point_id"), SAMPLE, seed=7), "n_drawn")
    both = per_id(i.dem(), "n_all").join(drawn, "point_id", "full")
    all_rows = F.sum("n_all")
    off = F.abs(F.sum("n_drawn") - SAMPLE * all_rows)
    return both.agg(
        (off <= 6 * F.sqrt(SAMPLE * (1 - SAMPLE) * all_rows)).alias("share_ok"),
        F.count_if(F.col("n_drawn") > F.col("n_all")).alias("n_repeats"),
        F.count_if(F.col("n_all").isNull()).alias("n_strangers"),
    )


@_query
def odd_lines_bounded(i: Inputs) -> DataFrame:
    """Short, blank, off-map, infinite and not-a-number lines, parsed and bounded."""
    return points.dem_bounds(points.parse_dem(i.odd_lines()))


@_query
def odd_gps_bounded(i: Inputs) -> DataFrame:
    """The same lines read as GPS points: heights are beside the point."""
    return points.gps_bounds(points.parse_gps(i.odd_lines()))


# --- grid, keys -------------------------------------------------------------

@_query
def zoom_grid(i: Inputs) -> DataFrame:
    """Grid of each zoom beside what the readings fill of it."""
    filled = pyramid.pyramid(pixels.pixel_max(_dem(i), MAX_ZOOM), MAX_ZOOM, tasks=_tasks(i))
    per_zoom = filled.groupBy("zoom").agg(F.count(F.lit(1)).alias("n_pixels"))
    return pixels.zoom_grid(i.spark, MAX_ZOOM).join(per_zoom, "zoom", "left")


@_query
def pixel_assign(i: Inputs) -> DataFrame:
    z = F.col("zoom")
    placed = pixels.with_tile(pixels.assign_pixels(_dem(i), MAX_ZOOM))
    return placed.select(
        "point_id", "zoom", "tile_x", "tile_y", "x", "y",
        grid.tile_lat(F.col("tile_y"), z).alias("tile_lat"),
        grid.tile_lon(F.col("tile_x"), z).alias("tile_lon"))


@_query
def snap_to_step(i: Inputs) -> DataFrame:
    lat, lon = grid.snap_to_step(F.col("lat"), F.col("lon"), MEAN_ZOOM)
    return _dem(i).select("point_id", lat.alias("cell_lat"), lon.alias("cell_lon"))


@_query
def tile_key_text(i: Inputs) -> DataFrame:
    placed = pixels.with_tile(pixels.pixel_max(_dem(i), MAX_ZOOM))
    key = grid.tile_key_text(*[F.col(c) for c in ("zoom", "tile_x", "tile_y", "x", "y")])
    names = ("tile_lat", "tile_lon", "key_zoom", "key_x", "key_y")
    keyed = placed.select(key.alias("key"))
    return keyed.select(
        "key", *[c.alias(n) for c, n in zip(grid.split_tile_key(F.col("key")), names)])


@_query
def geohash_points(i: Inputs) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    return _dem(i).select("point_id", *[keys.geohash(lat, lon, n).alias(f"geohash{n}") for n in (6, 8, 10)])


@_query
def geohash_decode(i: Inputs) -> DataFrame:
    keyed = _dem(i).select("point_id", keys.geohash(F.col("lat"), F.col("lon"), 8).alias("geohash"))
    lat, lon = keys.geohash_decode(F.col("geohash"), 8)
    return keyed.select("point_id", "geohash", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


@_query
def geohash_groups(i: Inputs) -> DataFrame:
    return gps.geohash_groups(_dem(i)).withColumn("mean_height", _round("mean_height", 6))


# --- pixels, pyramids -------------------------------------------------------

@_query
def pixel_max(i: Inputs) -> DataFrame:
    return pixels.with_tile(pixels.pixel_max(_dem(i), PIXEL_ZOOM))


@_query
def tile_pixels(i: Inputs) -> DataFrame:
    """Pixels keyed by their tile, the place in the tile beside the value."""
    placed = pixels.with_tile(pixels.pixel_max(_dem(i), MAX_ZOOM))
    keyed = placed.select("zoom", "tile_x", "tile_y", F.struct("x", "y", "alt").alias("pixel"))
    return keyed.select("zoom", "tile_x", "tile_y", "pixel.*")


@_query
def pixel_argmax(i: Inputs) -> DataFrame:
    return pixels.with_tile(pixels.pixel_argmax(_dem(i), PIXEL_ZOOM))


@_query
def pixel_mean(i: Inputs) -> DataFrame:
    return pixels.with_tile(pixels.pixel_mean(_dem(i), PIXEL_ZOOM))


@_query
def cell_mean(i: Inputs) -> DataFrame:
    return pixels.cell_mean(_dem(i), MEAN_ZOOM)


@_query
def pyramid_max(i: Inputs) -> DataFrame:
    return pyramid.pyramid(pixels.pixel_max(_dem(i), MAX_ZOOM), MAX_ZOOM, tasks=_tasks(i))


@_query
def pyramid_by_level(i: Inputs) -> DataFrame:
    return pyramid.pyramid_by_level(pixels.pixel_max(_dem(i), MAX_ZOOM), MAX_ZOOM)


@_query
def pyramid_fanout(i: Inputs) -> DataFrame:
    return pyramid.pyramid_fanout(pixels.pixel_max(_dem(i), MAX_ZOOM), MAX_ZOOM, tasks=_tasks(i))


@_query
def pixels_all_zooms(i: Inputs) -> DataFrame:
    return pixels.pixels_all_zooms(_dem(i), MAX_ZOOM, tasks=_tasks(i))


@_query
def pyramid_mean(i: Inputs) -> DataFrame:
    return pyramid.pyramid(pixels.cell_mean(_dem(i), MEAN_ZOOM), MEAN_ZOOM, agg="mean", tasks=_tasks(i))


@_query
def pyramid_mean_of_means(i: Inputs) -> DataFrame:
    return pyramid.pyramid_mean_of_means(pixels.cell_mean(_dem(i), MEAN_ZOOM), MEAN_ZOOM)


# --- tiles, colours ---------------------------------------------------------

def _tile_pyramid(i: Inputs) -> DataFrame:
    return pyramid.pyramid(pixels.pixel_max(_dem(i), TILE_ZOOM), TILE_ZOOM, tasks=_tasks(i))


@_query
def tile_blob(i: Inputs) -> DataFrame:
    packed = tiles.pack_tiles(_tile_pyramid(i))
    return packed.select("zoom", "geohash", "tile_x", "tile_y",
                         F.length("tile").alias("n_bytes"), F.md5("tile").alias("digest"))


@_query
def tile_unpack(i: Inputs) -> DataFrame:
    return tiles.unpack_tiles(tiles.pack_tiles(_tile_pyramid(i)))


@_query
def tile_rgba(i: Inputs) -> DataFrame:
    coloured = tiles.tile_rgba(_tile_pyramid(i), "gps")
    return coloured.select("zoom", "geohash", "tile_x", "tile_y",
                           F.length("raster").alias("n_bytes"), F.md5("raster").alias("digest"))


@_query
def pyramid_size(i: Inputs) -> DataFrame:
    return tiles.pyramid_size(tiles.pack_tiles(_tile_pyramid(i)))


def _dense_pyramid(i: Inputs) -> DataFrame:
    return pyramid.pyramid(pixels.pixel_max(points.dem_bounds(i.dense()), MAX_ZOOM), MAX_ZOOM, tasks=_tasks(i))


@_query
def tile_blob_dense(i: Inputs) -> DataFrame:
    """Rasters of zooms 0 to 10 over full tiles."""
    packed = tiles.pack_tiles(_dense_pyramid(i))
    return packed.select("zoom", "geohash", "tile_x", "tile_y",
                         F.length("tile").alias("n_bytes"), F.md5("tile").alias("digest"))


@_query
def stored_tile_lookup(i: Inputs) -> DataFrame:
    """Tiles written once as a table, then looked up for every reading at one of the zooms."""
    path = store.scratch_path(i.spark, "dense-tiles")
    store.write_sorted_tiles(tiles.pack_tiles(_dense_pyramid(i), ranged=True), path)
    zoom = (F.col("point_id") % 11).cast("int").alias("zoom")
    asked = points.dem_bounds(i.dense()).select(F.col("point_id").alias("request_id"), "lat", "lon", zoom)
    stored = store.read_tiles(i.spark, path).select("zoom", "tile_x", "tile_y", "geohash", F.md5("tile").alias("digest"))
    return serving.tile_lookup(asked, stored).select("request_id", "zoom", "tile_x", "tile_y", "geohash", "digest")


def _digests(stored: DataFrame) -> DataFrame:
    return stored.select("zoom", "geohash", "tile_x", "tile_y", F.length("tile").alias("n_bytes"), F.md5("tile").alias("digest"))


def _tile_table_of(i: Inputs, readings: DataFrame) -> str:
    """A pyramid of rasters, stored in key ranges and rolled up from its finest zoom."""
    path = store.scratch_path(i.spark, "tile-table")
    tile_table.build_tile_table(i.spark, tile_table.finest_tiles(readings, MAX_ZOOM), path, MAX_ZOOM)
    store.drop_at_exit(i.spark, path)
    return path


@_query
def tiles_rollup(i: Inputs) -> DataFrame:
    """Zooms 9 to 0 from the stored rasters of zoom 10, without a row per pixel."""
    return _digests(tile_table.read_tile_table(i.spark, _tile_table_of(i, points.dem_bounds(i.dense()))))


@_query
def tiles_incremental(i: Inputs) -> DataFrame:
    """The odd half of the readings put into the stored pyramid of the even half."""
    readings = points.dem_bounds(i.dense())
    path = _tile_table_of(i, readings.where("point_id % 2 = 0"))
    odd = tile_table.finest_tiles(readings.where("point_id % 2 <> 0"), MAX_ZOOM)
    tile_table.update_tile_table(i.spark, odd, path, MAX_ZOOM)
    return _digests(tile_table.read_tile_table(i.spark, path))


@_query
def tile_rgba_stored(i: Inputs) -> DataFrame:
    """All stored rasters coloured as they are."""
    stored = tile_table.read_tile_table(i.spark, _tile_table_of(i, points.dem_bounds(i.dense())))
    return rasters.tile_rgba_stored(stored, "gps").select(
        "zoom", "geohash", "tile_x", "tile_y", F.length("raster").alias("n_bytes"), F.md5("raster").alias("digest"))


@_query
def stored_key_lookup(i: Inputs) -> DataFrame:
    """For each reading the tile below or beside it at one of the zooms, read from the stored table by key intervals."""
    zoom = (F.col("point_id") % (MAX_ZOOM + 1)).cast("int")
    readings = points.dem_bounds(i.dense())
    x, y = grid.tile_index(F.col("lat"), F.col("lon"), F.col("zoom"))
    asked = readings.withColumn("zoom", zoom).select(F.col("point_id").alias("request_id"), "zoom", x.alias("tile_x"), (y + F.col("zoom") % 2).cast("int").alias("tile_y"))
    stored = tile_table.read_tile_table(i.spark, _tile_table_of(i, readings))
    found = tile_table.lookup_tiles(asked, stored.withColumn("digest", F.md5("tile")), ["geohash", "digest"])
    return found.select("request_id", "zoom", "tile_x", "tile_y", "geohash", "digest")


@_query
def stored_tiles_in_boxes(i: Inputs) -> DataFrame:
    """Rasters in a box around every map view's south-west corner, moved to where readings lie."""
    stored = tile_table.read_tile_table(i.spark, _tile_table_of(i, points.dem_bounds(i.dense())))
    digests = stored.withColumn("digest", F.md5("tile")).drop("tile")
    return tile_table.tiles_in_boxes(i.near_boxes(MAX_ZOOM), digests).select("request_id", "zoom", "geohash", "digest")


@_query
def visit_tiles_merged(i: Inputs) -> DataFrame:
    """Visits of even and of odd numbers as two pyramids of count rasters, merged and unpacked."""
    found = points.gps_bounds(i.dense_gps())
    packed = lambda half: rasters.pack_visits(
        pyramid.pyramid(gps.gps_pixels(half, MAX_ZOOM), MAX_ZOOM, agg="count", tasks=_tasks(i, "events")))
    merged = rasters.merge_visits(packed(found.where("point_id % 2 = 0")), packed(found.where("point_id % 2 <> 0")))
    return rasters.unpack_visits(merged)


@_query
def visit_tile_peaks(i: Inputs) -> DataFrame:
    """Visits of the busiest pixel of each zoom, from rasters."""
    levels = pyramid.pyramid(gps.gps_pixels(points.gps_bounds(i.dense_gps()), MAX_ZOOM), MAX_ZOOM, agg="count", tasks=_tasks(i, "events"))
    return rasters.visit_peaks(rasters.pack_visits(levels))


@_query
def stored_points_upsert(i: Inputs) -> DataFrame:
    """Points of odd number put into a stored table of the even ones."""
    found = points.gps_bounds(i.gps())
    path = store.scratch_path(i.spark, "point-table")
    tile_table.write_point_table(gps.points_upsert(found.where("point_id % 2 = 0"), "point_id"), path)
    tile_table.upsert_point_table(i.spark, gps.points_upsert(found.where("point_id % 2 <> 0"), "point_id"), path)
    store.drop_at_exit(i.spark, path)
    return tile_table.read_point_table(i.spark, path).select("geohash", "value")


@_query
def tile_unpack_dense(i: Inputs) -> DataFrame:
    return tiles.unpack_tiles(tiles.pack_tiles(_dense_pyramid(i)))


@_query
def pyramid_size_dense(i: Inputs) -> DataFrame:
    return tiles.pyramid_size(tiles.pack_tiles(_dense_pyramid(i)))


@_query
def tiles_roundtrip(i: Inputs) -> DataFrame:
    """Recreate the table, write it, replace one zoom, read back a key range."""
    path = store.scratch_path(i.spark, "tiles")
    store.create_tile_table(i.spark, path)
    packed = tiles.pack_tiles(_tile_pyramid(i), ranged=True)
    store.write_sorted_tiles(packed, path)
    last = tiles.pack_tiles(pixels.pixel_max(_dem(i), TILE_ZOOM))
    store.write_tiles(last, path, only_given_zooms=True)
    return store.read_tiles(i.spark, path).select(
        "zoom", "geohash", "tile_x", "tile_y", F.md5("tile").alias("digest"))


@_query
def tiles_sorted(i: Inputs) -> DataFrame:
    return tiles.tiles_sorted(_tile_table(i))


def _colour(i: Inputs, palette: str) -> DataFrame:
    return tiles.pixel_colour(pixels.pixel_max(_dem(i), PIXEL_ZOOM), palette)


@_query
def pixel_colour_custom(i: Inputs) -> DataFrame:
    """A ramp given as an object, its stops out of order."""
    ramp = {"name": "own", "values": {"0.75": [1, 0.5, 0.25], "0.25": [0, 0.25, 1], "0.5": [0.5, 1, 0.5]}}
    return tiles.pixel_colour(pixels.pixel_max(_dem(i), PIXEL_ZOOM), palette_from_object(ramp))


@_query
def pixel_colour_gps(i: Inputs) -> DataFrame:
    return _colour(i, "gps")


@_query
def pixel_colour_rainbow(i: Inputs) -> DataFrame:
    return _colour(i, "rainbow")


@_query
def pixel_colour_hotmap(i: Inputs) -> DataFrame:
    return _colour(i, "hotmap")


# --- binary elevation files -------------------------------------------------

@_query
def decode_hgt(i: Inputs) -> DataFrame:
    found = hgt.decode_hgt(i.hgt_files(HGT_SIDE), HGT_SIDE)
    return found.select(_round("lat", 9), _round("lon", 9), "height")


@_query
def hgt_to_text(i: Inputs) -> DataFrame:
    return hgt.points_to_text(hgt.decode_hgt(i.hgt_files(HGT_SIDE), HGT_SIDE))


@_query
def hgt_files_roundtrip(i: Inputs) -> DataFrame:
    """Readings to elevation files of 1201 x 1201 heights, written by the tasks, read back by their length."""
    path = store.scratch_path(i.spark, "hgt")
    hgt.write_hgt_files(hgt.encode_hgt(i.dense(), hgt.GRID_SIDE), path)
    store.drop_at_exit(i.spark, path)
    return hgt.read_hgt(i.spark, path).select(_round("lat", 9), _round("lon", 9), "height")


@_query
def dem_text_roundtrip(i: Inputs) -> DataFrame:
    """Write readings as text, scan the files, parse them."""
    path = store.scratch_path(i.spark, "dem-text")
    store.write_lines(hgt.points_to_text(i.dem()), path)
    return points.parse_dem(points.read_lines(i.spark, path))


# --- GPS --------------------------------------------------------------------

@_query
def gps_pixel_centroid(i: Inputs) -> DataFrame:
    found = gps.gps_pixels(points.gps_bounds(i.gps()), PIXEL_ZOOM)
    return pixels.with_tile(found).withColumns({c: F.round(c, 9) for c in ("lat", "lon")})


@_query
def gps_dedupe(i: Inputs) -> DataFrame:
    return gps.gps_dedupe(i.gps())


@_query
def gps_heat(i: Inputs) -> DataFrame:
    return pixels.with_tile(gps.gps_heat(points.gps_bounds(i.gps()), PIXEL_ZOOM))


@_query
def points_upsert(i: Inputs) -> DataFrame:
    return gps.points_upsert(points.gps_bounds(i.gps()), "point_id")


@_query
def points_merge(i: Inputs) -> DataFrame:
    """Points of odd number put over a store of the even ones."""
    found = points.gps_bounds(i.gps())
    stored = gps.points_upsert(found.where("point_id % 2 = 0"), "point_id")
    return gps.merge_points(stored, gps.points_upsert(found.where("point_id % 2 <> 0"), "point_id"))


@_query
def visit_pyramid(i: Inputs) -> DataFrame:
    """Visits per pixel at all zooms."""
    finest = gps.gps_pixels(points.gps_bounds(i.gps()), MAX_ZOOM)
    return pyramid.pyramid(finest, MAX_ZOOM, agg="count", tasks=_tasks(i, "events"))


@_query
def gps_text_export(i: Inputs) -> DataFrame:
    """Write visit counts as text and read the lines back."""
    path = store.scratch_path(i.spark, "gps-text")
    found = pixels.with_tile(gps.gps_pixels(points.gps_bounds(i.gps()), PIXEL_ZOOM))
    lines = found.select(F.concat_ws(",", "zoom", "tile_x", "tile_y", "x", "y", "n").alias("line"))
    store.write_lines(lines, path)
    return points.read_lines(i.spark, path)


# --- places -----------------------------------------------------------------

@_query
def cities_clean(i: Inputs) -> DataFrame:
    return place_files.parse_cities(i.city_lines())


@_query
def cities_keep_missing(i: Inputs) -> DataFrame:
    return place_files.parse_cities(i.city_lines(), keep_missing=True)


@_query
def cities_wide(i: Inputs) -> DataFrame:
    return place_files.parse_cities_wide(i.city_lines())


@_query
def regions_clean(i: Inputs) -> DataFrame:
    return place_files.parse_regions(i.region_lines())


@_query
def region_hex_code(i: Inputs) -> DataFrame:
    return place_files.region_hex_code(place_files.parse_regions(i.region_lines()))


def _joined_cities(i: Inputs) -> DataFrame:
    return places.join_regions(
        place_files.parse_cities(i.city_lines()), place_files.parse_regions(i.region_lines()))


@_query
def city_region_join(i: Inputs) -> DataFrame:
    return _joined_cities(i)


@_query
def city_by_geohash(i: Inputs) -> DataFrame:
    return places.city_by_geohash(_joined_cities(i))


@_query
def city_cells(i: Inputs) -> DataFrame:
    return places.city_cells(places.city_by_geohash(_joined_cities(i)))


@_query
def city_cells_wide(i: Inputs) -> DataFrame:
    return places.cells_wide(places.city_cells(places.city_by_geohash(_joined_cities(i))))


# --- statistics -------------------------------------------------------------

def _stats(df: DataFrame, col: str) -> DataFrame:
    return stats.summary_stats(df, col).select("n", _round("mean", 6), _round("stdev", 6), "max", "min")


@_query
def height_stats(i: Inputs) -> DataFrame:
    return _stats(i.dem(), "height")


@_query
def gps_lon_stats(i: Inputs) -> DataFrame:
    return _stats(i.gps(), "lon")


@_query
def height_stats_sample(i: Inputs) -> DataFrame:
    return _stats(gps.sample_hash(i.dem(), SAMPLE, "point_id"), "height")


@_query
def gps_lon_stats_sample(i: Inputs) -> DataFrame:
    return _stats(gps.sample_hash(i.gps(), SAMPLE, "point_id"), "lon")


@_query
def height_histogram_edges(i: Inputs) -> DataFrame:
    return stats.histogram_edges(i.dem(), "height")


@_query
def gps_lon_histogram_edges(i: Inputs) -> DataFrame:
    return stats.histogram_edges(i.gps(), "lon")


@_query
def height_histogram_auto(i: Inputs) -> DataFrame:
    return stats.histogram_auto(i.dem(), "height").withColumns(
        {c: F.round(c, 6) for c in ("low", "high")})


@_query
def gps_lon_histogram_auto(i: Inputs) -> DataFrame:
    return stats.histogram_auto(i.gps(), "lon").withColumns(
        {c: F.round(c, 6) for c in ("low", "high")})


# --- serving ----------------------------------------------------------------

def _tile_table(i: Inputs) -> DataFrame:
    levels = pyramid.pyramid(pixels.pixel_max(_dem(i), STORE_ZOOM), STORE_ZOOM, tasks=_tasks(i))
    return tiles.tile_summary(levels)


@_query
def viewport_cover(i: Inputs) -> DataFrame:
    return serving.viewport_cover(i.viewports())


def _boxes(i: Inputs) -> DataFrame:
    wanted = serving.clamp_zoom(serving.view_zoom(serving.view_span(), F.col("width_px")), 0, STORE_ZOOM)
    return i.viewports().withColumn("zoom", wanted).drop("width_px")


@_query
def tiles_in_bbox(i: Inputs) -> DataFrame:
    found = serving.tiles_in_bbox(_boxes(i), _tile_table(i))
    return found.select("request_id", "zoom", "geohash", "n_pixels", "max_alt")


@_query
def tile_lookup(i: Inputs) -> DataFrame:
    packed = tiles.pack_tiles(_tile_pyramid(i)).select(
        "zoom", "tile_x", "tile_y", "geohash", F.md5("tile").alias("digest"))
    found = serving.tile_lookup(i.tile_requests(TILE_ZOOM + 1), packed)
    return found.select("request_id", "zoom", "tile_x", "tile_y", "geohash", "digest")


@_query
def viewport_missing(i: Inputs) -> DataFrame:
    return serving.viewport_missing(serving.viewport_cover(i.viewports()), _tile_table(i))


@_query
def tiles_visible(i: Inputs) -> DataFrame:
    return serving.tiles_visible(_tile_table(i), -10.0, -20.0, 45.0, 60.0, 2)


@_query
def key_search(i: Inputs) -> DataFrame:
    found = serving.key_search(_tile_table(i), "S[0-9].*0")
    return found.select("geohash", "zoom", "n_hits")


@_query
def hot_tiles(i: Inputs) -> DataFrame:
    return serving.hot_tiles(serving.viewport_cover(i.viewports()))
