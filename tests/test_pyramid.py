import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from altigrid.operators import pixels, pyramid
from tests.conftest import SMALL

Z = 10


def pixel_table(spark, data, zoom):
    return spark.createDataFrame([(zoom, *d) for d in data], "zoom int, gx int, gy int, alt int")


def test_four_children(spark, rows):
    found = pyramid.pyramid(pixel_table(spark, [(4, 6, 3), (5, 6, 7), (5, 7, 5)], 1), 1)
    assert rows(found.where("zoom = 0")) == [(0, 2, 3, 7)]


def test_all_ways_agree(readings):
    finest = pixels.pixel_max(readings, Z)
    ways = [
        pyramid.pyramid(finest, Z), pyramid.pyramid_by_level(finest, Z),
        pyramid.pyramid_fanout(finest, Z), pixels.pixels_all_zooms(readings, Z),
    ]
    first = ways[0].select("zoom", "gx", "gy", "alt").cache()
    assert first.count() == first.select("zoom", "gx", "gy").distinct().count()
    for other in ways[1:]:
        other = other.select(first.columns)
        assert first.exceptAll(other).count() == 0 and other.exceptAll(first).count() == 0
    first.unpersist()


def test_deeper_than_one_block(spark, rows):
    data = [(k * 37 % 4096, k * 91 % 2048, k % 500) for k in range(300)]
    base = pixel_table(spark, data, 13).groupBy("zoom", "gx", "gy").agg(F.max("alt").alias("alt"))
    deep = pyramid.pyramid(base, 13)
    assert rows(deep, "zoom", "gx", "gy", "alt") == rows(
        pyramid.pyramid_by_level(base, 13), "zoom", "gx", "gy", "alt")


@pytest.mark.parametrize("build", [pyramid.pyramid, pyramid.pyramid_by_level, pyramid.pyramid_fanout])
def test_counts_are_kept_at_every_zoom(readings, build):
    visits = readings.transform(lambda d: pixels.assign_pixels(d, 6)).groupBy("zoom", "gx", "gy").agg(
        F.count(F.lit(1)).alias("n"))
    per_zoom = build(visits, 6, agg="count").groupBy("zoom").agg(F.sum("n").alias("n")).collect()
    assert {r.n for r in per_zoom} == {readings.count()} and len(per_zoom) == 7


def test_mean_weighs_points_and_mean_of_means_does_not(spark, rows):
    # Three readings of 10 in one cell, one of 50 in its neighbour.
    data = [(10.0, 10.0, 10)] * 3 + [(10.0, 100.0, 50)]
    points = spark.createDataFrame(data, "lat double, lon double, height int")
    cells = pixels.cell_mean(points, 1)
    assert rows(cells, "gx", "gy", "alt", "n") == [(2, 1, 10, 3), (3, 1, 50, 1)]
    assert rows(pyramid.pyramid(cells, 1, agg="mean").where("zoom = 0"), "alt") == [(20,)]
    assert rows(pyramid.pyramid_mean_of_means(cells, 1).where("zoom = 0"), "alt") == [(30,)]


def test_highest_point_and_its_ties(spark, rows):
    data = [(10.0, 20.0, 5), (10.0, 20.001, 9), (10.001, 20.0, 9), (10.0, 20.002, 9)]
    points = spark.createDataFrame(data, "lat double, lon double, height int")
    assert rows(pixels.pixel_argmax(points, 0), "lat", "lon", "height") == [(10.0, 20.001, 9)]
    assert rows(pixels.pixel_max(points, 0), "alt") == [(9,)]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        pyramid.pyramid(pixel_table(spark, [(0, 0, 0)], 1), 1, agg="median")


def test_points_are_combined_before_the_shuffle(readings, plan):
    text = plan(pixels.pixel_max(readings, 5))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_pyramid_moves_pixels_once(readings):
    found = pyramid.pyramid(pixels.pixel_max(readings, Z), Z)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # One exchange reduces points to pixels, one brings blocks together; the
    # union reads the latter three times.
    assert text.count("FileScan") == 1 and text.count("+- Exchange") == 2
    assert text.count("ReusedExchange") == 2


@pytest.mark.parametrize("name", ["zoom_grid", "pyramid_max", "pyramid_fanout", "pixels_all_zooms", "pyramid_mean"])
def test_many_pixels_are_dealt_to_tasks_by_their_number(spark, monkeypatch, rows, plan, name):
    """The planner would join partitions of so few bytes, however many rows each becomes."""
    query = entry_points.queries()[name]
    few = query(spark, SMALL)
    assert "REPARTITION_BY_NUM" not in plan(few)
    n = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(pyramid, "TASK_PIXELS", 500)
    many = query(spark, SMALL)
    assert pyramid.tasks_for(spark, 500) is None and pyramid.tasks_for(spark, n) == -(-n // 500) > 10
    assert f", {-(-n // 500)}), REPARTITION_BY_NUM" in plan(many)
    assert rows(many, *sorted(many.columns)) == rows(few, *sorted(few.columns))
