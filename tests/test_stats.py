import numpy as np
import pytest

from altigrid.operators import gps, stats


def column(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def counts(df):
    return {r.bucket: r.n for r in df.collect() if r.n}


def test_given_edges(spark):
    df = column(spark, [0, 79, 80, 7839, 7840, 7920, 7921, -1])
    found = stats.histogram_edges(df, "v")
    assert found.count() == 99 and counts(found) == {0: 2, 1: 1, 97: 1, 98: 2}
    last = found.where("bucket = 98").first()
    assert (last.low, last.high) == (7840.0, 7920.0)


@pytest.mark.parametrize("edges", [[0, 1, 10, 100, 1000, 5000], [0.1 * i for i in range(30)], [-5.0, 5.0]])
def test_any_edges_equal_numpy(spark, edges):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.uniform(-10, 5100, 500), rng.uniform(0, 3, 500), np.array(edges, float)])
    found = stats.histogram_edges(column(spark, values.tolist(), "double"), "v", edges)
    assert [r.n for r in found.orderBy("bucket").collect()] == np.histogram(values, edges)[0].tolist()


def test_edges_must_increase(spark):
    with pytest.raises(ValueError):
        stats.histogram_edges(column(spark, [1]), "v", [1, 1])


def test_equal_buckets(spark):
    values = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None]
    found = stats.histogram_auto(column(spark, values), "v", 5)
    assert counts(found) == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert found.where("bucket = 4").first().high == 10.0


def test_equal_buckets_of_one_value(spark):
    assert counts(stats.histogram_auto(column(spark, [7, 7, 7]), "v", 4)) == {0: 3}


def test_equal_buckets_equal_numpy(spark):
    values = np.random.default_rng(4).uniform(-180, 180, 3000)
    found = stats.histogram_auto(column(spark, values.tolist(), "double"), "v", 7).orderBy("bucket")
    assert [r.n for r in found.collect()] == np.histogram(values, 7)[0].tolist()


def test_heights_are_read_once_and_longitudes_never_shuffled(inputs):
    def final_plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    heights = final_plan(stats.histogram_auto(inputs.dem(), "height"))
    assert "ReusedExchange" in heights and heights.count("FileScan") <= 1
    longitudes = final_plan(stats.histogram_auto(inputs.gps(), "lon"))
    assert "hashpartitioning(v#" not in longitudes


def test_summary(spark):
    row = stats.summary_stats(column(spark, [2, 4, 4, 4, 5, 5, 7, 9]), "v").first()
    assert tuple(row) == (8, 5.0, 2.0, 9, 2)


def test_samples(spark, rows):
    ids = spark.range(100_000)
    drawn = gps.sample_bernoulli(ids, 0.01, seed=3)
    assert 800 < drawn.count() < 1200 and drawn.distinct().count() == drawn.count()
    hashed = gps.sample_hash(ids, 0.01, "id")
    assert 900 < hashed.count() < 1100
    assert rows(hashed) == rows(gps.sample_hash(ids.repartition(7), 0.01, "id"))
    # Ids far beyond 32 bits do not overflow.
    assert gps.sample_hash(spark.range(2**62, 2**62 + 1000), 0.5, "id").count() > 300


def test_gps_groups(spark, rows):
    data = [(1.0, 2.0)] * 3 + [(1.0, 2.01), (50.0, 60.0)]
    points = spark.createDataFrame(data, "lat double, lon double")
    assert rows(gps.gps_dedupe(points)) == [(1.0, 2.0, 3), (1.0, 2.01, 1), (50.0, 60.0, 1)]
    visits = gps.gps_pixels(points, 0)
    assert rows(visits, "n") == [(1,), (4,)]
    assert visits.where("n = 4").first().lon == pytest.approx(2.0025)
    assert rows(gps.gps_heat(points, 0), "heat") == [(0.25,), (1.0,)]


def test_last_value_wins(spark, rows):
    points = spark.createDataFrame(
        [(1, 10.00001, 20.0), (3, 10.00002, 20.9), (2, 10.0, 20.0), (4, -10.5, -0.9)],
        "point_id bigint, lat double, lon double")
    close = gps.points_upsert(points.where("lon <> 20.9"), "point_id")
    assert rows(close, "value") == [(-11,), (30,)]
    stored = gps.points_upsert(points, "point_id")
    assert stored.count() == 3
    update = spark.createDataFrame([(close.where("value = 30").first().geohash, 77)], stored.schema)
    assert rows(gps.merge_points(stored, update), "value") == [(-11,), (30,), (77,)]


def test_geohash_groups(spark, rows):
    points = spark.createDataFrame(
        [(1.0, 2.0, 10), (1.0, 2.0, 20), (30.0, 40.0, 5)], "lat double, lon double, height int")
    assert rows(gps.geohash_groups(points), "n", "min_height", "max_height", "mean_height") == [
        (1, 5, 5, 5.0), (2, 10, 20, 15.0)]


def test_equal_buckets_leave_infinity_out(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, float("inf"), float("-inf"), float("nan"), None)], "v double")
    found = stats.histogram_auto(df, "v", 2).orderBy("bucket").collect()
    assert [(r.low, r.high, r.n) for r in found] == [(0.0, 0.5, 1), (0.5, 1.0, 1)]
