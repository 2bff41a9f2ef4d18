import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from altigrid.functions import grid
from altigrid.functions.geohash import ALPHABET, geohash, geohash_decode, tile_geohash
from altigrid.operators.pixels import assign_pixels, with_tile, zoom_grid


@pytest.fixture(scope="module", autouse=True)
def columns(spark):
    """Columns can only be made once a session is active."""
    global LAT, LON
    LAT, LON = F.col("lat"), F.col("lon")


@pytest.fixture(scope="module")
def cloud(spark):
    """Random points, tile corners, and the last doubles inside the map."""
    rng = np.random.default_rng(5)
    free = zip(rng.uniform(-90, 90, 3000), rng.uniform(-180, 180, 3000))
    corners = [(-90 + 180 / 64 * i, -180 + 180 / 64 * j) for i in range(0, 64, 3) for j in range(0, 128, 7)]
    edges = [(math.nextafter(90, 0), math.nextafter(180, 0)), (-90.0, -180.0), (0.0, 0.0)]
    data = [(float(a), float(b)) for a, b in [*free, *corners, *edges]]
    return spark.createDataFrame(data, "lat double, lon double").cache()


def bisect(lat, lon, n):
    """Geohash by halving intervals."""
    box = [[-180.0, 180.0], [-90.0, 90.0]]
    out, code = "", 0
    for bit in range(5 * n):
        low, high = box[bit % 2]
        mid = (low + high) / 2
        above = (lon, lat)[bit % 2] >= mid
        box[bit % 2] = [mid, high] if above else [low, mid]
        code = code * 2 + above
        if bit % 5 == 4:
            out, code = out + ALPHABET[code], 0
    return out


def test_known_pixel(spark):
    point = spark.createDataFrame([(45.5, 3.25)], "lat double, lon double")
    assigned = assign_pixels(point, 0)
    assert assigned.select("gx", "gy").first() == (260, 192)
    assert with_tile(assigned).select("tile_x", "tile_y", "x", "y").first() == (1, 0, 4, 192)
    corner = grid.tile_lat(F.lit(0), 0), grid.tile_lon(F.lit(1), 0)
    assert point.select(*corner).first() == (-90.0, 0.0)


def test_index_is_inside_and_halves_exactly(spark, cloud):
    # Shifting the origin rounds a point this close to an edge onto it, at all zooms alike.
    near = [(math.nextafter(e, -200), math.nextafter(2 * e, -200)) for e in (0.0, 22.5, 45.0, -78.75)]
    cloud = cloud.unionByName(spark.createDataFrame(near, "lat double, lon double"))
    for zoom in (1, 5, 10, 19):
        (gx, gy), (px, py) = (grid.pixel_index(LAT, LON, z) for z in (zoom, zoom - 1))
        side = 256 << zoom
        bad = cloud.where(
            (gx < 0) | (gx >= 2 * side) | (gy < 0) | (gy >= side)
            | (F.shiftright(gx, 1) != px) | (F.shiftright(gy, 1) != py))
        assert bad.count() == 0


def test_index_by_zoom_column(cloud):
    by_column = grid.pixel_index(LAT, LON, F.col("zoom"))
    by_number = grid.pixel_index(LAT, LON, 7)
    both = cloud.withColumn("zoom", F.lit(7))
    assert both.where((by_column[0] != by_number[0]) | (by_column[1] != by_number[1])).count() == 0


def test_snapped_corner_holds_its_point(cloud):
    for zoom in (0, 3, 9):
        lat, lon = grid.snap_to_step(LAT, LON, zoom)
        step = 180.0 / 2**zoom
        outside = cloud.where((lat > LAT) | (lat + step < LAT) | (lon > LON) | (lon + step < LON))
        assert outside.count() == 0


def test_zoom_grid(spark, rows):
    assert rows(zoom_grid(spark, 2)) == [(0, 1, 2, 180.0), (1, 2, 4, 90.0), (2, 4, 8, 45.0)]


def test_clamp(spark):
    values = spark.range(-2, 4).select(grid.clamp(F.col("id"), 0, 2).alias("v"))
    assert [r.v for r in values.collect()] == [0, 0, 0, 1, 2, 2]


def test_public_geohash(spark):
    point = spark.createDataFrame([(57.64911, 10.40744)], "lat double, lon double")
    assert point.select(geohash(LAT, LON, 8)).first()[0] == "u4pruydq"


@pytest.mark.parametrize("length", [1, 5, 6, 7, 8, 10, 12])
def test_geohash_equals_bisection(cloud, length):
    found = cloud.select("lat", "lon", geohash(LAT, LON, length).alias("key")).collect()
    assert all(r.key == bisect(r.lat, r.lon, length) for r in found)


def test_shorter_key_is_a_prefix(cloud):
    keys = [geohash(LAT, LON, n) for n in (6, 8, 10)]
    assert cloud.where(~keys[1].startswith(keys[0]) | ~keys[2].startswith(keys[1])).count() == 0


@pytest.mark.parametrize("length", [5, 6, 8, 11])
def test_decoded_centre_is_within_half_a_cell(cloud, length):
    lat, lon = geohash_decode(geohash(LAT, LON, length), length)
    bits = 5 * length
    half_lon, half_lat = 180 / 2 ** (bits - bits // 2), 90 / 2 ** (bits // 2)
    far = cloud.where((F.abs(lat - LAT) > half_lat * (1 + 1e-9)) | (F.abs(lon - LON) > half_lon * (1 + 1e-9)))
    assert far.count() == 0


def test_tile_key_is_the_geohash_of_its_corner(spark):
    tiles = spark.range(11).select(F.col("id").cast("int").alias("zoom")).select(
        "zoom", F.explode(F.sequence(F.lit(0), F.least(F.lit(40), F.shiftleft(F.lit(1), 3)))).alias("k"))
    tiles = tiles.where(F.col("k") < F.call_function("shiftleft", F.lit(1), F.col("zoom"))).select(
        "zoom", (F.col("k") * 2).alias("tile_x"), F.col("k").alias("tile_y"))
    z, x, y = (F.col(c) for c in ("zoom", "tile_x", "tile_y"))
    wrong = tiles.where(tile_geohash(z, x, y) != geohash(grid.tile_lat(y, z), grid.tile_lon(x, z), 8))
    assert tiles.count() > 50 and wrong.count() == 0


def test_tile_key_text_round_trip(spark):
    row = spark.createDataFrame([(3, 5, 2, 17, 255)], "zoom int, tile_x int, tile_y int, x int, y int")
    key = grid.tile_key_text(*[F.col(c) for c in row.columns])
    assert row.select(key).first()[0] == "-45.0#-67.5#3#17#255"
    assert row.select(*grid.split_tile_key(key)).first() == (-45.0, -67.5, 3, 17, 255)


def test_no_key_off_the_map_or_beyond_the_zoom_limit(spark):
    where = spark.createDataFrame([(-95.0, 0.0), (0.0, -190.0), (float("nan"), 0.0), (90.0, 180.0)], "lat double, lon double")
    keys = [r.k for r in where.select(geohash(F.col("lat"), F.col("lon"), 6).alias("k")).collect()]
    assert keys[:3] == [None] * 3 and keys[3] == "zzzzzz"
    with pytest.raises(Exception, match="zoom of 0 to 19"):
        spark.range(1).select(tile_geohash(F.lit(20) + F.col("id").cast("int"), F.lit(0), F.lit(0))).collect()
