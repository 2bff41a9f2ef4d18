"""Stored tables that are updated in place, and raster operations, beside numpy and loops."""

import glob
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from altigrid.__main__ import main
from altigrid.functions.geohash import tile_geohash
from altigrid.functions.grid import band_of, tile_code
from altigrid.functions.palette import PALETTES
from altigrid.operators import gps, pixels, pyramid, rasters, serving, tiles
from altigrid.sources import hgt, store, tile_table

ZOOM = 7
POINTS = "lat double, lon double, height int"


def readings(spark, seed, n, low=(40.0, 0.0), high=(60.0, 40.0)):
    rng = np.random.default_rng(seed)
    rows = zip(rng.uniform(low[0], high[0], n), rng.uniform(low[1], high[1], n), rng.integers(0, 9000, n))
    return spark.createDataFrame([(float(a), float(b), int(h)) for a, b, h in rows], POINTS)


def by_pixels(points, zoom=ZOOM):
    """The whole pyramid packed from pixels of every zoom."""
    return tiles.pack_tiles(pyramid.pyramid_by_level(pixels.pixel_max(points, zoom), zoom))


def content(df):
    return {(r.zoom, r.tile_x, r.tile_y, r.geohash): bytes(r.tile) for r in df.collect()}


def files(path):
    return {f[len(path):]: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/zoom=*/band=*/*.parquet")}


@pytest.fixture(scope="module")
def first(spark):
    return readings(spark, 1, 600).cache()


@pytest.fixture
def table(spark, first, tmp_path):
    path = str(tmp_path / "table")
    tile_table.build_tile_table(spark, tile_table.finest_tiles(first, ZOOM), path, ZOOM)
    return path


# --- codes --------------------------------------------------------------------

def test_codes_interleave_and_order_as_geohashes_do(spark):
    rng = random.Random(1)
    rows = [(z, rng.randrange(2 << z), rng.randrange(1 << z)) for z in (0, 1, 5, 10, 19) for _ in range(60)]
    df = spark.createDataFrame(rows, "zoom int, tile_x int, tile_y int")
    x, y = F.col("tile_x"), F.col("tile_y")
    found = df.select("*", tile_code(x, y).alias("code"), tile_geohash(F.col("zoom"), x, y).alias("key"), band_of(tile_code(x, y)).alias("band")).collect()
    for r in found:
        assert r.code == sum((r.tile_x >> k & 1) << 2 * k | (r.tile_y >> k & 1) << 2 * k + 1 for k in range(20))
        assert r.band == r.code >> 11
    for zoom in {r.zoom for r in found}:
        own = [r for r in found if r.zoom == zoom]
        assert [r.key for r in sorted(own, key=lambda r: r.code)] == sorted(r.key for r in own)


# --- roll-up --------------------------------------------------------------------

@pytest.mark.parametrize("zoom,levels", [(3, 1), (3, 3), (6, 5), (6, 2)])
def test_rolled_up_rasters_are_those_of_pixels(spark, zoom, levels):
    points = readings(spark, zoom, 300, (-90.0, -180.0), (89.9, 179.9))
    finest = tiles.pack_tiles(pixels.pixel_max(points, zoom))
    found = content(rasters.rollup_tiles(finest, zoom, levels))
    wanted = content(by_pixels(points, zoom).where(F.col("zoom").between(zoom - levels, zoom - 1)))
    assert found == wanted


def test_roll_up_moves_quarters_once_and_no_pixel_rows(spark, first, plan):
    finest = spark.createDataFrame([], "zoom int, geohash string, tile_x int, tile_y int, tile binary")
    text = plan(rasters.rollup_tiles(finest, ZOOM, 5))
    assert text.count("Exchange") == 1 and "Generate" not in text
    with pytest.raises(ValueError):
        rasters.rollup_tiles(finest, 3, 4)
    assert rasters.rollup_tiles(finest, ZOOM, 5).count() == 0


def test_table_of_all_zooms(spark, first, table):
    assert content(tile_table.read_tile_table(spark, table)) == content(by_pixels(first))


def test_the_finest_pixels_cross_two_exchanges(spark, first, tmp_path, plan):
    """One to reduce readings, one to pack; the sorted write adds none."""
    finest = tile_table.finest_tiles(first, ZOOM)
    code = tile_code(F.col("tile_x"), F.col("tile_y"))
    written = finest.withColumn("band", band_of(code)).withColumn("code", code).sortWithinPartitions("zoom", "band", "code")
    assert plan(written).count("Exchange") == 2
    path = str(tmp_path / "t")
    tile_table.write_tile_table(finest, path, ranged=True)
    assert content(tile_table.read_tile_table(spark, path)) == content(tiles.pack_tiles(pixels.pixel_max(first, ZOOM)))


# --- updates --------------------------------------------------------------------

def test_update_equals_the_full_build_and_leaves_other_files(spark, first, table):
    before = files(table)
    near = readings(spark, 2, 80, (50.0, 10.0), (51.0, 11.0))
    touched = tile_table.update_tile_table(spark, tile_table.finest_tiles(near, ZOOM), table, ZOOM)
    assert content(tile_table.read_tile_table(spark, table)) == content(by_pixels(first.union(near)))
    after = files(table)
    folder = lambda f: tuple(int(p.split("=")[1]) for p in f.split("/")[1:3])
    stayed = {f for f in before if folder(f) not in touched}
    assert stayed and all(after.get(f) == before[f] for f in stayed)
    assert all(f not in after for f in set(before) - stayed)
    assert {z for z, _ in touched} == set(range(ZOOM + 1)) and len(touched) < len({folder(f) for f in before})


def test_update_into_new_ground_and_by_nothing(spark, first, table):
    tile_table.update_tile_table(spark, tile_table.finest_tiles(first.where("false"), ZOOM), table, ZOOM)
    assert content(tile_table.read_tile_table(spark, table)) == content(by_pixels(first))
    far = readings(spark, 3, 40, (-60.0, -100.0), (-50.0, -90.0))
    tile_table.update_tile_table(spark, tile_table.finest_tiles(far, ZOOM), table, ZOOM)
    assert content(tile_table.read_tile_table(spark, table)) == content(by_pixels(first.union(far)))


def test_a_failed_run_leaves_the_table_whole(spark, first, table):
    before, rows = files(table), content(tile_table.read_tile_table(spark, table))
    broken = tile_table.read_tile_table(spark, table).withColumn(
        "tile", F.when(F.col("zoom") == ZOOM, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.lit(b"x")))
    with pytest.raises(Exception, match="lost"):
        tile_table.replace_bands(broken, table)
    assert files(table) == before and content(tile_table.read_tile_table(spark, table)) == rows


def test_merged_tiles(spark):
    one = lambda *px: spark.createDataFrame([(0, gx, gy, alt) for gx, gy, alt in px], "zoom int, gx int, gy int, alt int")
    a, b = tiles.pack_tiles(one((0, 0, 5), (1, 1, 9))), tiles.pack_tiles(one((0, 0, 7), (2, 2, 1), (300, 3, 4)))
    assert content(rasters.merge_tiles(a, b)) == content(tiles.pack_tiles(one((0, 0, 7), (1, 1, 9), (2, 2, 1), (300, 3, 4))))


# --- look-up and boxes ------------------------------------------------------------

def rows_scanned(df):
    """Rows that the scans of a finished query put out."""
    total = 0
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        kind = node.getClass().getSimpleName()
        if kind.endswith("QueryStageExec"):
            stack.append(node.plan())
        stack += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_lookup_reads_few_rasters(spark, first, table):
    stored = tile_table.read_tile_table(spark, table)
    n = stored.count()
    some = stored.where(F.col("zoom") == ZOOM).orderBy("code").limit(3).select("zoom", "tile_x", "tile_y").collect()
    asked = [(k, r.zoom, r.tile_x, r.tile_y) for k, r in enumerate(some)] + [(90, ZOOM, 0, 0), (91, 2, 4, 3), (92, ZOOM, some[0].tile_x, some[0].tile_y)]
    requests = spark.createDataFrame(asked, "request_id int, zoom int, tile_x int, tile_y int")
    found = tile_table.lookup_tiles(requests, stored)
    every = content(by_pixels(first))
    wanted = {(z, x, y): (key, blob) for (z, x, y, key), blob in every.items()}
    rows = found.collect()
    assert sorted(r.request_id for r in rows) == sorted(a[0] for a in asked)
    for r in rows:
        key, blob = wanted.get((r.zoom, r.tile_x, r.tile_y), (None, None))
        assert r.geohash == key and (None if r.tile is None else bytes(r.tile)) == blob
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "GreaterThanOrEqual(code" in text
    near = stored.where(tile_table.in_intervals(tile_table.covering(
        requests.select("zoom", tile_code(F.col("tile_x"), F.col("tile_y")).alias("first")).withColumn("last", F.col("first")))))
    assert near.count() * 10 < n


def test_lookup_reads_the_requests_twice(spark, table, tmp_path, rows):
    """Once to count their keys, once to answer them."""
    path = str(tmp_path / "asked")
    asked = spark.range(300).select(F.col("id").alias("request_id"), F.lit(2).alias("zoom"), (F.col("id") % 8).cast("int").alias("tile_x"), F.lit(3).alias("tile_y"))
    asked.write.parquet(path)
    found = tile_table.lookup_tiles(spark.read.parquet(path), tile_table.read_tile_table(spark, table))
    plain = asked.join(tile_table.read_tile_table(spark, table), ["zoom", "tile_x", "tile_y"], "left")
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("request_id") and sum("Relation [" in x and "request_id" in x for x in text.splitlines()) == 1
    assert sum("Relation [" in x and "tile_x" in x and "tile_y" in x and "geohash" not in x for x in text.splitlines()) == 1
    assert rows(found, "request_id", "geohash") == rows(plain, "request_id", "geohash")


def test_intervals_cover_and_are_few(spark):
    rng = random.Random(7)
    rows = [(z, c, c + rng.randrange(5)) for z in (3, 9) for c in (rng.randrange(1 << 2 * z + 1) for _ in range(400))]
    codes = spark.createDataFrame(rows, "zoom int, first long, last long")
    for most in (1, 10, 64, 5000):
        found = tile_table.covering(codes, most)
        assert len(found) <= max(2 * most, 2)
        assert all(any(z == zoom and a <= first and last <= b for z, a, b in found) for zoom, first, last in rows)


def test_boxes_of_a_stored_table(spark, first, table):
    rng = random.Random(9)
    rows = []
    for k in range(60):
        a, b = rng.uniform(-90, 80), rng.uniform(-180, 170)
        rows.append((k, a, b, min(90.0, a + rng.choice([0.0, 1.0, 30.0, 170.0])), b + rng.choice([0.0, 0.5, 9.0]), rng.randrange(ZOOM + 1)))
    rows += [(100, -90.0, -180.0, 90.0, 180.0, ZOOM), (101, 45.0, 170.0, 55.0, 30.0, ZOOM)]
    boxes = spark.createDataFrame(rows, "request_id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int")
    stored = tile_table.read_tile_table(spark, table)
    for most in (2, 64):
        found = sorted((r.request_id, r.zoom, r.geohash) for r in tile_table.tiles_in_boxes(boxes, stored, most).select("request_id", "zoom", "geohash").collect())
        cover = serving.box_tiles(boxes).join(stored, ["zoom", "tile_x", "tile_y"])
        assert found == sorted((r.request_id, r.zoom, r.geohash) for r in cover.select("request_id", "zoom", "geohash").collect())


def test_boxes_read_the_tiles_once(spark, first, table, plan):
    boxes = spark.createDataFrame([(1, 45.0, 5.0, 50.0, 9.0, 5)], "request_id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(serving.tiles_in_bbox(boxes, tile_table.read_tile_table(spark, table).drop("code", "band")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Two exchanges of the join, two of the short list of block sizes.
    assert text.count("FileScan parquet") == 1 and text.count("Exchange") <= 4


# --- colours, visits ---------------------------------------------------------------

@pytest.mark.parametrize("name", [*PALETTES, "no such ramp"])
def test_colour_table_is_the_column_ramp(spark, name):
    alts = [-8000, -1, 0, 1, 2500, 4807, 8000, 8848, 9000]
    px = spark.createDataFrame([(0, k, 0, a) for k, a in enumerate(alts)], "zoom int, gx int, gy int, alt int")
    table = rasters.colour_table(name)
    for r in tiles.pixel_colour(px, name).collect():
        assert tuple(table[r.alt + tiles.ALTITUDE_SHIFT]) == (r.red, r.green, r.blue, 255)
    assert tuple(table[0]) == (0, 0, 0, 0)


def test_stored_rasters_coloured(spark, first):
    levels = pyramid.pyramid_by_level(pixels.pixel_max(first, 2), 2)
    packed = tiles.pack_tiles(levels)
    found = {(r.zoom, r.geohash): bytes(r.raster) for r in rasters.tile_rgba_stored(packed, "rainbow").collect()}
    assert found == {(r.zoom, r.geohash): bytes(r.raster) for r in tiles.tile_rgba(levels, "rainbow").collect()}


def test_visit_rasters(spark, rows):
    px = [(1, 0, 0, 3), (1, 255, 255, 1), (1, 256, 0, rasters.MOST_VISITS + 5), (1, 700, 300, 70_000), (0, 9, 8, 256)]
    more = [(1, 0, 0, 4), (1, 256, 0, 9), (1, 1, 0, 2)]
    schema = "zoom int, gx int, gy int, n long"
    a, b = (rasters.pack_visits(spark.createDataFrame(p, schema)) for p in (px, more))
    held = [(z, x, y, min(n, rasters.MOST_VISITS)) for z, x, y, n in px]
    assert rows(rasters.unpack_visits(a), "zoom", "gx", "gy", "n") == sorted(held)
    assert {len(bytes(r.tile)) for r in a.collect()} == {4 * 65536}
    merged = [(0, 9, 8, 256), (1, 0, 0, 7), (1, 1, 0, 2), (1, 255, 255, 1), (1, 256, 0, rasters.MOST_VISITS), (1, 700, 300, 70_000)]
    both = rasters.merge_visits(a, b)
    assert rows(rasters.unpack_visits(both), "zoom", "gx", "gy", "n") == merged
    assert rows(rasters.visit_peaks(both), "zoom", "peak") == [(0, 256), (1, rasters.MOST_VISITS)]


# --- points, files, jobs -------------------------------------------------------------

def test_upsert_rewrites_only_touched_prefixes(spark, tmp_path, rows):
    path = str(tmp_path / "points")
    old = spark.createDataFrame([("u0abcd", 1), ("u0abce", 2), ("s5zzzz", 3), ("7hbbbb", 4)], "geohash string, value int")
    tile_table.write_point_table(old, path)
    names = {os.path.basename(f) for f in glob.glob(f"{path}/prefix=[s7]*/*.parquet")}
    new = spark.createDataFrame([("u0abce", 20), ("u0zzzz", 5), (None, 6)], "geohash string, value int")
    assert tile_table.upsert_point_table(spark, new, path) == ["u0"]
    found = rows(tile_table.read_point_table(spark, path), "geohash", "value")
    assert found == [("7hbbbb", 4), ("s5zzzz", 3), ("u0abcd", 1), ("u0abce", 20), ("u0zzzz", 5)]
    assert names == {os.path.basename(f) for f in glob.glob(f"{path}/prefix=[s7]*/*.parquet")}
    bad = new.withColumn("value", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tile_table.upsert_point_table(spark, bad, path)
    assert rows(tile_table.read_point_table(spark, path), "geohash", "value") == found
    assert tile_table.upsert_point_table(spark, new.where("false"), path) == []


def test_elevation_files_of_both_sizes(spark, tmp_path):
    points = spark.createDataFrame([(-0.5, -0.25, 100), (-0.5, -0.25, 300), (12.0, 100.0, 7), (12.99999, 100.99999, 9)], POINTS)
    assert hgt.write_hgt_files(hgt.encode_hgt(points, 1201), str(tmp_path)) == 2
    assert sorted(os.listdir(tmp_path)) == ["N12E100.hgt", "S01W001.hgt"]
    assert {os.path.getsize(tmp_path / f) for f in os.listdir(tmp_path)} == {2 * 1201 * 1201}
    fine = np.full((3601, 3601), hgt.VOID, ">i2")
    fine[0, 0], fine[3600, 3600] = 11, 22
    (tmp_path / "N50E007.hgt").write_bytes(fine.tobytes())
    found = sorted((round(r.lat, 6), round(r.lon, 6), r.height) for r in hgt.read_hgt(spark, str(tmp_path)).collect())
    step = 1 / 1200
    assert found == sorted([(-0.5, -0.25, 300), (12.0, 100.0, 7), (round(12 + 1199 * step, 6), round(100 + 1199 * step, 6), 9), (51.0, 7.0, 11), (50.0, 8.0, 22)])
    (tmp_path / "N51E007.hgt").write_bytes(b"\0" * 20)
    with pytest.raises(Exception, match="no known grid size"):
        hgt.read_hgt(spark, str(tmp_path)).count()


def test_jobs(spark, tmp_path, rows):
    text = lambda name, data: (tmp_path / name).write_text("\n".join(data))
    text("a.txt", ["45.5,3.25,1200", "-10,20,300", "bad"])
    text("b.txt", ["45.5,3.25,900", "45.6,3.3,1500"])
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    main(["tile-table", "--source", str(tmp_path / "a.txt"), "--out", table, "--max-zoom", "6"])
    main(["update-tiles", "--source", str(tmp_path / "b.txt"), "--out", table, "--max-zoom", "6"])
    points = spark.createDataFrame([(45.5, 3.25, 1200), (-10.0, 20.0, 300), (45.6, 3.3, 1500)], POINTS)
    assert content(tile_table.read_tile_table(spark, table)) == content(by_pixels(points, 6))
    main(["render", "--source", table, "--out", f"{out}/rgba"])
    assert spark.read.parquet(f"{out}/rgba").count() == tile_table.read_tile_table(spark, table).count()
    for kind, schema, values, n in [
        ("box", "id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int", [(1, -90.0, -180.0, 90.0, 180.0, 6)], 2),
        ("lookup", "id int, lat double, lon double, zoom int", [(1, 45.5, 3.25, 6), (2, 80.0, 100.0, 6)], 2),
        ("key", "zoom int, geohash string", [(0, "h0000000"), (0, "00000000")], 2),
    ]:
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / kind))
        main(["serve", "--source", table, "--requests", str(tmp_path / kind), "--out", out, "--kind", kind, "--banded"])
        assert spark.read.parquet(f"{out}/{kind}").count() == n
    stored = str(tmp_path / "points")
    for name in ("a.txt", "b.txt"):
        main(["upsert-points", "--source", str(tmp_path / name), "--out", stored])
    assert sorted(r.value for r in tile_table.read_point_table(spark, stored).collect()) == [10, 48, 48]


def test_a_view_over_the_date_line_is_no_wider_than_another(spark):
    views = spark.createDataFrame([(1, 0.0, 170.0, 20.0, -170.0, 512), (2, 0.0, 20.0, 20.0, 40.0, 512), (3, -80.0, 1.0, 80.0, 1.001, 512)],
                                  "id int, lat_min double, lon_min double, lat_max double, lon_max double, width_px int")
    found = serving.viewport_cover(views).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("zoom").alias("zoom")).collect()
    by_id = {r.id: (r.n, r.zoom) for r in found}
    assert by_id[1][1] == by_id[2][1] == 5 and max(n for n, _ in by_id.values()) < 40
