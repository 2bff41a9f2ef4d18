"""Point files: ``lat,lng,height`` and ``lat,lng`` text.

``mode="strict"`` drops a line with a bad field. ``mode="compat"`` sets each
bad field to 0, so that such lines land on the origin. Not-a-number is a double
and passes the parser; the strict bounds drop it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from altigrid.functions.grid import LAT_MAX, LAT_MIN, LON_MAX, LON_MIN
from altigrid.functions.text import parse_rows, to_double, to_integer

STRICT, COMPAT = "strict", "compat"
HEIGHT_MIN, HEIGHT_MAX = 0, 9000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as one column ``line``, split by block."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def _check(mode: str) -> None:
    if mode not in (STRICT, COMPAT):
        raise ValueError(f"unknown mode {mode!r}")


def _numbers(lines: DataFrame, mode: str, names: dict[str, str], keep_bad: bool) -> DataFrame:
    _check(mode)

    def fields(at) -> dict[str, Column]:
        found = {}
        for i, (name, kind) in enumerate(names.items()):
            value = to_integer(at(i)) if kind == "int" else to_double(at(i))
            found[name] = F.coalesce(value, F.lit(0).cast(kind)) if mode == COMPAT else value
        return found

    needed = [] if mode == COMPAT or keep_bad else list(names)
    return parse_rows(lines, fields, needed)


def parse_dem(lines: DataFrame, mode: str = STRICT, keep_bad: bool = False) -> DataFrame:
    """``lat,lng,height`` lines to (lat, lon, height); ``keep_bad`` leaves nulls in."""
    return _numbers(lines, mode, {"lat": "double", "lon": "double", "height": "int"}, keep_bad)


def parse_gps(lines: DataFrame, mode: str = STRICT) -> DataFrame:
    """``lat,lng`` lines to (lat, lon)."""
    return _numbers(lines, mode, {"lat": "double", "lon": "double"}, False)


def parse_points_rowfail(lines: DataFrame) -> DataFrame:
    """``lat,lng`` lines; any bad field sends the whole point to (0, 0).

    ``ok`` tells the two apart, and ``line`` is kept to report the failures.
    """
    def fields(at) -> dict[str, Column]:
        lat, lon = to_double(at(0)), to_double(at(1))
        ok = lat.isNotNull() & lon.isNotNull()
        whole = lambda v: F.when(ok, v).otherwise(F.lit(0.0))
        return {"lat": whole(lat), "lon": whole(lon), "ok": ok}

    return parse_rows(lines, fields, [], keep=["line"])


def failed_lines(points: DataFrame) -> DataFrame:
    """The side output of :func:`parse_points_rowfail`: lines that did not parse."""
    return points.where(~F.col("ok")).select("line")


def _inside(mode: str) -> Column:
    lat, lon = F.col("lat"), F.col("lon")

    def between(value: Column, low: float, high: float) -> Column:
        ok = (value >= F.lit(low)) & (value < F.lit(high))
        return ok | F.isnan(value) if mode == COMPAT else ok

    return between(lat, LAT_MIN, LAT_MAX) & between(lon, LON_MIN, LON_MAX)


def dem_bounds(points: DataFrame, mode: str = STRICT) -> DataFrame:
    """Keep points on the map with a height in 0..9000 m (compat lets NaN pass)."""
    _check(mode)
    return points.where(_inside(mode) & F.col("height").between(HEIGHT_MIN, HEIGHT_MAX))


def gps_bounds(points: DataFrame, mode: str = STRICT) -> DataFrame:
    """Keep points on the map."""
    _check(mode)
    return points.where(_inside(mode))


def dem_positive(points: DataFrame) -> DataFrame:
    """Keep strictly positive heights (drops sea level and voids)."""
    return points.where(F.col("height") > 0)


def inline_points(spark: SparkSession, rows: list[tuple[int, float, float, float]]) -> DataFrame:
    """A small keyed dataset from literals: (id, height, lat, lon)."""
    return spark.createDataFrame(rows, "id int, height double, lat double, lon double")
