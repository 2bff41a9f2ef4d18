import numpy as np
import pytest
from pyspark.sql import functions as F

from altigrid.functions.palette import (
    GPS, PALETTES, altitude_share, colour, palette_from_object, palette_stops, to_byte)
from altigrid.operators import pixels, pyramid, tiles
from altigrid.sources import store


def pixel_table(spark, data):
    return spark.createDataFrame(data, "zoom int, gx int, gy int, alt int")


@pytest.fixture(scope="module")
def levels(readings):
    return pyramid.pyramid(pixels.pixel_max(readings, 2), 2)


def test_stored_bytes(spark):
    packed = tiles.pack_tiles(pixel_table(spark, [(0, 0, 0, 0), (0, 0, 1, 255), (0, 255, 255, 9000)]))
    tile = packed.first().tile
    assert len(tile) == tiles.TILE_BYTES
    assert tile[:6].hex() == "018000810000" and tile[-2:].hex() == "29a3"
    assert set(tile[4:-2]) == {0}


@pytest.mark.parametrize("ranged", [False, True])
def test_tiles_equal_a_numpy_model(levels, ranged):
    model = {}
    for r in levels.collect():
        tile = model.setdefault((r.zoom, r.gx >> 8, r.gy >> 8), np.zeros((256, 256), "<u2"))
        tile[r.gx & 255, r.gy & 255] = r.alt + 32769
    packed = tiles.pack_tiles(levels, ranged).collect()
    assert {(t.zoom, t.tile_x, t.tile_y): bytes(t.tile) for t in packed} == {
        k: v.tobytes() for k, v in model.items()}


def test_full_tile(spark):
    every = spark.range(65536).select(
        F.lit(1).alias("zoom"), (256 + F.shiftright("id", 8)).cast("int").alias("gx"),
        F.col("id").bitwiseAND(F.lit(255)).cast("int").alias("gy"),
        (F.col("id") % 9001).cast("int").alias("alt"))
    tile = np.frombuffer(bytes(tiles.pack_tiles(every).first().tile), "<u2").astype(int)
    assert (tile - 32769 == np.arange(65536) % 9001).all()


def test_pack_and_unpack(levels, rows):
    back = tiles.unpack_tiles(tiles.pack_tiles(levels))
    assert rows(back) == rows(pixels.with_tile(levels))


def test_pixel_counts_agree_with_the_summary(levels, rows):
    counted = tiles.unpack_tiles(tiles.pack_tiles(levels)).groupBy("zoom", "tile_x", "tile_y").count()
    assert rows(counted) == rows(tiles.tile_summary(levels), "zoom", "tile_x", "tile_y", "n_pixels")


def test_size_of_a_full_map(spark, rows):
    packed = tiles.pack_tiles(pixel_table(spark, [(3, 0, 0, 1), (3, 300, 0, 1), (0, 0, 0, 1)]))
    assert rows(tiles.pyramid_size(packed)) == [
        (0, 1, 131072, 2, 262144), (3, 2, 262144, 128, 128 * 131072)]


# --- colours ----------------------------------------------------------------

def expected_colour(v, stops):
    """The ramp by its definition: between the first stop above v and the one before."""
    for k, s in enumerate(stops):
        if v < s[0]:
            p = stops[max(0, k - 1)]
            share = (v - s[0]) / (p[0] - s[0]) if p[0] != s[0] else 0.0
            return tuple((a - b) * share + b for a, b in zip(p[1:], s[1:]))
    return stops[-1][1:]


@pytest.mark.parametrize("name", list(PALETTES))
def test_ramp(spark, name):
    values = [-0.5, 0.0, 0.1, 0.25, 0.333, 0.4999999, 0.5, 0.51, 0.5312, 0.7, 0.999, 1.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", colour(F.col("v"), name).alias("c")).collect():
        assert (r.c.r, r.c.g, r.c.b) == pytest.approx(expected_colour(r.v, PALETTES[name]), abs=1e-12)


def test_shore_is_at_sea_level(spark):
    df = spark.createDataFrame([(-1,), (0,)], "alt int")
    sea, land = [r.c for r in df.select(colour(altitude_share(F.col("alt")), "gps").alias("c")).collect()]
    assert sea.b > 0.99 and (land.r, land.g, land.b) == GPS[9][1:]


def test_custom_and_unknown_palettes(spark):
    stops = palette_from_object({"name": "mine", "values": {"10": [1, 0, 0], "2": [0, 0, 1]}})
    assert [s[0] for s in stops] == [2.0, 10.0]
    df = spark.createDataFrame([(6.0,), (None,)], "v double")
    middle, missing = [r.c for r in df.select(colour(F.col("v"), stops).alias("c")).collect()]
    assert (middle.r, middle.g, middle.b) == (0.5, 0.0, 0.5) and missing.r is None
    assert palette_stops("no such") == []
    black = df.select(colour(F.col("v"), "no such").alias("c")).first().c
    assert (black.r, black.g, black.b) == (0.0, 0.0, 0.0)


def test_bytes_round_to_even(spark):
    df = spark.createDataFrame([(0.5 / 255,), (1.5 / 255,), (1.0,)], "v double")
    assert [r[0] for r in df.select(to_byte(F.col("v"))).collect()] == [0, 2, 255]


def test_raster_runs_from_the_north_west(spark):
    raster = bytes(tiles.tile_rgba(pixel_table(spark, [(0, 3, 255, 100), (0, 0, 0, 100)])).first().raster)
    assert len(raster) == 4 * 65536
    grid = np.frombuffer(raster, np.uint8).reshape(256, 256, 4)
    assert grid[0, 3, 3] == 255 and grid[255, 0, 3] == 255 and grid[:, :, 3].astype(int).sum() == 2 * 255
    assert tuple(grid[0, 3, :3]) == tuple(grid[255, 0, :3])


# --- store ------------------------------------------------------------------

def test_store_round_trip_in_key_order(spark, levels, rows, tmp_path):
    path = str(tmp_path / "tiles")
    packed = tiles.pack_tiles(levels, ranged=True)
    store.write_sorted_tiles(packed, path)
    assert rows(store.read_tiles(spark, path), "zoom", "geohash", "tile") == rows(
        packed, "zoom", "geohash", "tile")
    parts = store.read_tiles(spark, path).groupBy("zoom", F.input_file_name().alias("file")).agg(
        F.min("geohash").alias("lo"), F.max("geohash").alias("hi")).orderBy("zoom", "lo").collect()
    for a, b in zip(parts, parts[1:]):
        assert a.zoom != b.zoom or a.hi < b.lo


def test_one_zoom_is_replaced(spark, levels, tmp_path):
    path = str(tmp_path / "tiles")
    store.create_tile_table(spark, path)
    assert store.read_tiles(spark, path).count() == 0
    store.write_tiles(tiles.pack_tiles(levels), path)
    store.write_tiles(tiles.pack_tiles(pixel_table(spark, [(2, 0, 0, 1)])), path, only_given_zooms=True)
    counts = dict(store.read_tiles(spark, path).groupBy("zoom").count().collect())
    assert counts[2] == 1 and counts[0] == 2 and counts[1] == 8
    store.create_tile_table(spark, path)
    assert store.read_tiles(spark, path).count() == 0


def test_packing_for_the_store_moves_pixels_once(spark, levels, tmp_path, plan):
    path = str(tmp_path / "pixels")
    store.write_pixels(levels, path)
    packed = tiles.pack_tiles(store.read_pixels(spark, path), ranged=True)
    text = plan(packed.sortWithinPartitions("zoom", "geohash"))
    assert text.count("Exchange") == 1 and "rangepartitioning" in text


def test_key_filters_reach_the_scan(spark, levels, tmp_path, plan):
    from altigrid.operators.serving import tile_by_key

    path = str(tmp_path / "tiles")
    store.write_tiles(tiles.pack_tiles(levels), path)
    found = tile_by_key(store.read_tiles(spark, path), 1, "00000000")
    text = plan(found.select("tile_x"))
    assert "PartitionFilters: [isnotnull(zoom" in text and "EqualTo(geohash,00000000)" in text
    assert "ReadSchema: struct<geohash:string,tile_x:int>" in text
    assert found.count() == 1


def test_shared_folder_is_the_sessions(spark):
    assert store.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
