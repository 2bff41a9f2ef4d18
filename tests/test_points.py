import math

import pytest

from altigrid.sources import points

# line, strict result, compat result (after the bounds)
CASES = [
    ("45.5,3.25,1200", (45.5, 3.25, 1200), (45.5, 3.25, 1200)),
    ("-90,-180,0", (-90.0, -180.0, 0), (-90.0, -180.0, 0)),
    ("90,0,10", None, None),
    ("0,180,10", None, None),
    ("1,1,9000", (1.0, 1.0, 9000), (1.0, 1.0, 9000)),
    ("1,1,9001", None, None),
    ("1,1,-1", None, None),
    ("1,1,12.0", None, (1.0, 1.0, 0)),
    ("1,1, 12", None, (1.0, 1.0, 0)),
    ("1,1,99999999999", None, (1.0, 1.0, 0)),
    ("abc,1,5", None, (0.0, 1.0, 5)),
    ("1,1", None, (1.0, 1.0, 0)),
    ("2,3,4,extra", (2.0, 3.0, 4), (2.0, 3.0, 4)),
    ("", None, (0.0, 0.0, 0)),
]


@pytest.mark.parametrize("mode,at", [("strict", 1), ("compat", 2)])
def test_dem_lines(lines, rows, mode, at):
    found = points.dem_bounds(points.parse_dem(lines(*[c[0] for c in CASES]), mode), mode)
    assert rows(found) == sorted(c[at] for c in CASES if c[at])


def test_not_a_number_passes_only_in_compat(lines):
    nan = lines("NaN,1,5")
    assert points.dem_bounds(points.parse_dem(nan)).count() == 0
    kept = points.dem_bounds(points.parse_dem(nan, "compat"), "compat").collect()
    assert len(kept) == 1 and math.isnan(kept[0].lat)


def test_gps_lines(lines, rows):
    text = lines("1.5,2.5", "x,2", "3,", "")
    assert rows(points.parse_gps(text)) == [(1.5, 2.5)]
    assert rows(points.parse_gps(text, "compat")) == [(0.0, 0.0), (0.0, 2.0), (1.5, 2.5), (3.0, 0.0)]


def test_one_bad_field_fails_the_whole_point(lines, rows):
    found = points.parse_points_rowfail(lines("1.5,2.5", "x,2", "3"))
    assert rows(found, "lat", "lon", "ok") == [(0.0, 0.0, False), (0.0, 0.0, False), (1.5, 2.5, True)]
    assert rows(points.failed_lines(found)) == [("3",), ("x,2",)]


def test_gps_bounds(spark, rows):
    found = spark.createDataFrame(
        [(-90.0, -180.0), (90.0, 0.0), (0.0, 180.0), (89.9, 179.9)], "lat double, lon double")
    assert rows(points.gps_bounds(found)) == [(-90.0, -180.0), (89.9, 179.9)]


def test_positive_heights(spark, rows):
    found = spark.createDataFrame([(0,), (-3,), (5,)], "height int")
    assert rows(points.dem_positive(found)) == [(5,)]


def test_text_scan(spark, rows, tmp_path):
    (tmp_path / "a.txt").write_text("1,2,3\n4,5,6\n")
    (tmp_path / "b.txt").write_text("7,8,9")
    found = points.parse_dem(points.read_lines(spark, str(tmp_path)))
    assert rows(found, "height") == [(3,), (6,), (9,)]


def test_inline_points(spark):
    found = points.inline_points(spark, [(1, 1.0, 2.0, 3.0), (2, 2.0, 3.0, 4.0)])
    assert found.count() == 2 and found.columns == ["id", "height", "lat", "lon"]


def test_lines_are_parsed_once(lines, plan):
    text = plan(points.dem_bounds(points.parse_dem(lines("1,2,3"))))
    assert text.count("split(line") == 1


def test_unknown_mode(lines):
    with pytest.raises(ValueError):
        points.parse_dem(lines("1,2,3"), "loose")
