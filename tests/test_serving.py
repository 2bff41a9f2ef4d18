import math

import pytest
from pyspark.sql import functions as F

from altigrid.operators import pixels, pyramid, serving, tiles
from altigrid.operators.joins import split_join

VIEW = "request_id int, lat_min double, lon_min double, lat_max double, lon_max double, width_px int"


@pytest.fixture(scope="module")
def table(readings):
    return tiles.tile_summary(pyramid.pyramid(pixels.pixel_max(readings, 4), 4)).cache()


def cover_by_loops(lat_min, lon_min, lat_max, lon_max, width):
    """The client's loops: raise the zoom until its pixels are small enough, then step."""
    zoom = 0
    while 180 / (256 * 2**zoom) > (lon_max - lon_min) / width:
        zoom += 1
    step = 180 / 2**zoom
    found = set()
    for y in range(2**zoom):
        for x in range(2 ** (zoom + 1)):
            south, west = y * step - 90, x * step - 180
            if south < lat_max and south + step > lat_min and west < lon_max and west + step > lon_min:
                found.add((zoom, x, y))
    return found


@pytest.mark.parametrize("view", [
    (-90.0, -180.0, 90.0, 180.0, 512), (-90.0, -180.0, 90.0, 180.0, 2000),
    (10.0, 10.0, 40.0, 40.0, 256), (-3.0, -3.0, 3.0, 3.0, 256), (0.0, 0.0, 45.0, 90.0, 128),
    (-100.0, -200.0, -80.0, -170.0, 256)])
def test_cover(spark, rows, view):
    cover = serving.viewport_cover(spark.createDataFrame([(1, *view)], VIEW))
    assert set(rows(cover, "zoom", "tile_x", "tile_y")) == cover_by_loops(*view)
    assert cover.columns == ["request_id", "zoom", "tile_x", "tile_y"]


def test_box_off_the_map_has_no_tiles(spark):
    off = spark.createDataFrame([(1, 95.0, 0.0, 99.0, 4.0, 256)], VIEW)
    assert serving.viewport_cover(off).count() == 0


def test_zoom_is_limited(spark):
    tiny = spark.createDataFrame([(1e-9, 1000), (10.0, 256)], "span double, px int")
    zoom = serving.view_zoom(F.col("span"), F.col("px"), 7)
    assert [r[0] for r in tiny.select(zoom).collect()] == [7, math.ceil(math.log2(18))]


def test_tiles_in_boxes(spark, table):
    boxes = spark.createDataFrame(
        [(1, -20.0, -30.0, 10.0, 40.0, 3), (2, 0.0, 0.0, 1.0, 1.0, 0)],
        "request_id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int")
    found = {(r.request_id, r.zoom, r.tile_x, r.tile_y) for r in serving.tiles_in_bbox(boxes, table).collect()}
    wanted = set()
    stored = table.select("zoom", "tile_x", "tile_y").collect()
    for b in boxes.collect():
        step = 180 / 2**b.zoom
        for t in stored:
            s, w = t.tile_y * step - 90, t.tile_x * step - 180
            if (t.zoom == b.zoom and s < b.lat_max and s + step > b.lat_min
                    and w < b.lon_max and w + step > b.lon_min):
                wanted.add((b.request_id, t.zoom, t.tile_x, t.tile_y))
    assert found == wanted and len(found) > 5


def test_lookup(spark, table):
    asked = spark.createDataFrame([(1, 45.5, 3.25, 0), (2, 0.0, 0.0, 9)],
                                  "request_id int, lat double, lon double, zoom int")
    found = {r.request_id: r for r in serving.tile_lookup(asked, table).collect()}
    assert (found[1].tile_x, found[1].tile_y) == (1, 0) and found[1].geohash == "h0000000"
    assert found[2].geohash is None and found[2].tile_x == 512


def test_lookup_joins_only_the_tiles_asked_for(spark, table, plan):
    asked = spark.range(2000).select(
        F.col("id").alias("request_id"), (F.col("id") % 170 - 85).cast("double").alias("lat"),
        (F.col("id") % 350 - 175).cast("double").alias("lon"), (F.col("id") % 6).cast("int").alias("zoom"))
    text = plan(serving.tile_lookup(asked, table))
    assert "LeftSemi" in text and "SinglePartition" not in text


def test_missing(spark, table, rows):
    cover = serving.viewport_cover(spark.createDataFrame([(1, 10.0, 10.0, 40.0, 40.0, 256)], VIEW))
    have = cover.limit(1).select("zoom", "tile_x", "tile_y").unionByName(table.select("zoom", "tile_x", "tile_y"))
    missing = serving.viewport_missing(cover, have)
    assert missing.count() == cover.join(have, ["zoom", "tile_x", "tile_y"], "left_anti").count()


def test_visible(table):
    found = serving.tiles_visible(table, -10.0, -20.0, 45.0, 60.0, 2).collect()
    assert [(t.zoom, t.geohash) for t in found] == sorted((t.zoom, t.geohash) for t in found)
    for t in table.collect():
        step = 180 / 2**t.zoom
        s, w = t.tile_y * step - 90, t.tile_x * step - 180
        touches = t.zoom >= 2 and w <= 60 and w + step >= -20 and s <= 45 and s + step >= -10
        assert touches == ((t.zoom, t.geohash) in {(f.zoom, f.geohash) for f in found})


def test_search(table):
    found = serving.key_search(table, "S.*0", limit=3).collect()
    hits = sorted(r.geohash for r in table.collect() if "s" in r.geohash)
    assert [r.geohash for r in found] == hits[:3] and {r.n_hits for r in found} == {len(hits)}


def test_hot_tiles(spark):
    asked = spark.createDataFrame([(1, 0, 0)] * 3 + [(1, 1, 0)] * 5 + [(2, 0, 0)],
                                  "zoom int, tile_x int, tile_y int")
    top = serving.hot_tiles(asked, 2).collect()
    assert [(r.tile_x, r.n_requests) for r in top] == [(1, 5), (0, 3)]


# --- joins under skew -------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key."""
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"))
    right = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_split_join_equals_a_plain_join(skewed, rows, how):
    left, right = skewed
    found = split_join(left, right, ["k"], how, hot_rows=100)
    assert rows(found.fillna(-1), *sorted(found.columns)) == rows(
        left.join(right, ["k"], how).fillna(-1), *sorted(found.columns))


def test_hot_key_is_cut_into_pieces(spark, skewed):
    left, right = skewed
    from altigrid.operators import joins

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = joins.split_join(left, right, ["k"], "inner", hot_rows=100)
        sizes = [r["count"] for r in found.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == left.where("k = 7").count() and len(sizes) > 1


def test_equal_rows_on_one_key_part(spark):
    left = spark.range(3000).select(F.lit(7).cast("long").alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = split_join(left, right, ["k"], "inner", hot_rows=100)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and len(sizes) > 1


def test_boxes_over_the_date_line_and_without_area(spark, table, rows):
    box = "request_id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int"
    over = spark.createDataFrame([(1, -40.0, 170.0, 40.0, -170.0, 2)], box)
    parts = spark.createDataFrame([(1, -40.0, 170.0, 40.0, 180.0, 2), (1, -40.0, -180.0, 40.0, -170.0, 2)], box)
    assert rows(serving.box_tiles(over), "tile_x", "tile_y") == rows(serving.box_tiles(parts), "tile_x", "tile_y")
    assert {r.tile_x for r in serving.box_tiles(over).collect()} == {0, 7}
    assert rows(serving.tiles_in_bbox(over, table), "geohash") == rows(serving.tiles_in_bbox(parts, table), "geohash")
    spots = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0.0, 2), (2, 10.0, 10.0, 10.0, 10.0, 2), (3, 90.0, 180.0, 90.0, 180.0, 2)], box)
    assert rows(serving.box_tiles(spots), "request_id", "tile_x", "tile_y") == [(1, 4, 2), (2, 4, 2), (3, 7, 3)]


def test_a_box_of_the_world_is_few_blocks(spark):
    box = "lat_min double, lon_min double, lat_max double, lon_max double, zoom int"
    for zoom in (0, 3, 10, 19):
        world = spark.createDataFrame([(-90.0, -180.0, 90.0, 180.0, zoom)], box)
        assert 0 < serving.box_blocks(world).count() <= 64


def test_no_nested_loops(spark, inputs, table, plan):
    boxes = inputs.viewports().withColumn("zoom", F.lit(3))
    cover = serving.viewport_cover(inputs.viewports())
    for df in (cover, serving.tiles_in_bbox(boxes, table), serving.viewport_missing(cover, table),
               serving.tile_lookup(inputs.tile_requests(4), table)):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_boxes_are_never_gathered(spark, inputs, table, plan):
    """Blocks of boxes are many times their requests: both sides of the join are shuffled."""
    boxes = inputs.viewports().withColumn("zoom", F.lit(3))
    found = serving.tiles_in_bbox(boxes, table)
    assert "BroadcastExchange" not in plan(found) and "SortMergeJoin" in plan(found)
    cover = serving.box_tiles(boxes).join(table, ["zoom", "tile_x", "tile_y"])
    assert found.count() == cover.count() > 0
