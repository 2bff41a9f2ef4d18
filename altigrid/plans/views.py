"""Points, places and requests derived from the driver's tables.

Each view is whole: every row of its table becomes a row here. ``VIEW_SQL`` in
``oracles`` states the same rows as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class Inputs:
    """The derived inputs over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dem(self) -> DataFrame:
        """Elevation readings, one per line item: point_id, lat, lon, height."""
        order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        return self.table("lineitem").select(
            (order * 8 + line).alias("point_id"),
            _degrees(order * 7919 + line * 104729, 180000),
            _degrees(part * 104729 + supp * 7919 + order * 31, 360000, "lon"),
            ((order * 31 + part * 17 + line * 101) % 9500 - 200).cast("int").alias("height"),
        )

    def dense(self) -> DataFrame:
        """The same readings drawn together on two square degrees, so that fine tiles are full."""
        order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        near = lambda corner, number, span: (corner * 10000 + number % span).cast("double") / F.lit(10000.0)
        return self.table("lineitem").select(
            (order * 8 + line).alias("point_id"),
            near(F.lit(45), order * 7919 + line * 104729, 10000).alias("lat"),
            near(F.lit(5), part * 104729 + supp * 7919 + order * 31, 20000).alias("lon"),
            ((order * 31 + part * 17 + line * 101) % 9001).cast("int").alias("height"),
        )

    def dem_lines(self) -> DataFrame:
        """The readings as text, some with a height that is not a number."""
        height = F.when(F.col("point_id") % 53 == 0, "NA").otherwise(F.col("height").cast("string"))
        return self.dem().select(_csv(_milli("lat"), _milli("lon"), height))

    def odd_lines(self) -> DataFrame:
        """The readings as text, most kinds of bad line among them, by point_id."""
        kind = F.col("point_id") % 11
        lat = F.when(kind == 0, "NaN").when(kind == 1, "95.5").otherwise(_milli("lat"))
        lon = F.when(kind == 2, "-190.25").when(kind == 3, "Infinity").otherwise(_milli("lon"))
        height = F.when(kind == 4, "12.0").otherwise(F.col("height").cast("string"))
        line = F.when(kind == 5, "").when(kind == 6, _csv(lat, lon)).otherwise(_csv(lat, lon, height))
        return self.dem().select(line.alias("line"))

    def gps(self) -> DataFrame:
        """GPS points, one per event, with duplicates: point_id, lat, lon."""
        user, jitter = F.col("user_id"), F.col("event_id") % 5
        return self.table("events").select(
            F.col("event_id").alias("point_id"),
            _degrees(user * 7919 + jitter * 13, 180000),
            _degrees(user * 104729 + jitter * 29, 360000, "lon"),
        )

    def dense_gps(self) -> DataFrame:
        """The GPS points drawn together on two square degrees."""
        near = lambda corner, deg, span: F.lit(float(corner)) + F.pmod(F.floor(F.abs(deg) * 1000).cast("bigint"), F.lit(span)).cast("double") / F.lit(10000.0)
        return self.gps().select("point_id", near(45, F.col("lat"), 10000).alias("lat"), near(5, F.col("lon"), 20000).alias("lon"))

    def gps_lines(self) -> DataFrame:
        """The GPS points as text, some with a longitude that is not a number."""
        lon = F.when(F.col("point_id") % 41 == 0, "east").otherwise(_milli("lon"))
        return self.gps().select(_csv(_milli("lat"), lon))

    def cities(self) -> DataFrame:
        """Cities, one per customer, all fields as in the file."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        letter = F.when(nation % 2 == 0, "0").otherwise("A")
        people = F.when(key % 10 == 0, "").otherwise(((key * 37) % 100003).cast("string"))
        return self.table("customer").select(
            F.concat(F.lit("n"), nation.cast("string")).alias("country"),
            F.lower("c_name").alias("city"), F.col("c_name").alias("accent_city"),
            F.concat(letter, (key % 3).cast("string")).alias("region"),
            people.alias("population"),
            _degrees((key % 400) * 7919, 180000),
            _degrees((key % 400) * 104729, 360000, "lon"),
        )

    def city_lines(self) -> DataFrame:
        return self.cities().select(_csv(
            "country", "city", "accent_city", "region", "population", _milli("lat"), _milli("lon")))

    def region_lines(self) -> DataFrame:
        """Region codes as csv text, two per nation, names in quotes."""
        nation = F.col("n_nationkey")
        letter = F.when(nation % 2 == 0, "0").otherwise("A")
        r = F.explode(F.array(F.lit("0"), F.lit("1"))).alias("r")
        return self.table("nation").select("*", r).select(_csv(
            F.concat(F.lit("N"), nation.cast("string")),
            F.concat(letter, F.col("r")),
            F.concat(F.lit('"'), F.col("n_name"), F.lit(" R"), F.col("r"), F.lit('"')),
        ))

    def viewports(self) -> DataFrame:
        """Map views, one per order; one in fifty lies across the date line (lon_min > lon_max)."""
        order, cust = F.col("o_orderkey"), F.col("o_custkey")
        corner = self.table("orders").select(
            order.alias("request_id"),
            ((order * 7919) % 150000 - 90000).cast("double").alias("_lat"),
            ((order * 104729) % 300000 - 180000).cast("double").alias("_lon"),
            (1 + cust % 30).cast("double").alias("_span"),
            (256 + (cust % 4) * 256).cast("int").alias("width_px"),
        )
        lat, lon = F.col("_lat") / F.lit(1000.0), F.col("_lon") / F.lit(1000.0)
        across, half = F.col("request_id") % 50 == 0, F.col("_span") / F.lit(2.0)
        return corner.select(
            "request_id", lat.alias("lat_min"), F.when(across, F.lit(180.0) - half).otherwise(lon).alias("lon_min"),
            (lat + F.col("_span")).alias("lat_max"),
            F.when(across, F.lit(-180.0) + half).otherwise(lon + F.col("_span")).alias("lon_max"),
            "width_px")

    def near_boxes(self, max_zoom: int) -> DataFrame:
        """Boxes of an eighth to one degree where the dense readings lie, one per order, at any zoom."""
        order, cust = F.col("o_orderkey"), F.col("o_custkey")
        lat = F.lit(45.0) + (order * 7919 % 1000).cast("double") / F.lit(1000.0)
        lon = F.lit(5.0) + (order * 104729 % 2000).cast("double") / F.lit(1000.0)
        span = (1 + cust % 8).cast("double") / F.lit(8.0)
        return self.table("orders").select(
            order.alias("request_id"), lat.alias("lat_min"), lon.alias("lon_min"),
            (lat + span).alias("lat_max"), (lon + span).alias("lon_max"), (cust % (max_zoom + 1)).cast("int").alias("zoom"))

    def tile_requests(self, max_zoom: int) -> DataFrame:
        """One tile request per order: request_id, lat, lon, zoom."""
        order, cust = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            order.alias("request_id"),
            _degrees(order * 7919, 180000),
            _degrees(order * 104729, 360000, "lon"),
            (cust % (max_zoom + 1)).cast("int").alias("zoom"))

    def hgt_files(self, n: int) -> DataFrame:
        """Elevation files of n x n heights, one per degree cell that has readings.

        (path, content): row 0 is the north edge, a cell holds its highest
        reading, and cells without one are void.
        """
        lat0, lon0 = F.floor("lat"), F.floor("lon")
        cell = lambda deg, low: F.floor((F.col(deg) - low) * F.lit(float(n - 1)))
        row = F.lit(n - 1) - cell("lat", lat0)
        readings = self.dem().groupBy(
            lat0.cast("int").alias("lat0"), lon0.cast("int").alias("lon0"),
            (row * n + cell("lon", lon0)).cast("int").alias("at"),
        ).agg(F.max("height").alias("height"))
        files = readings.groupBy("lat0", "lon0").agg(
            F.map_from_entries(F.collect_list(F.struct("at", "height"))).alias("heights"))
        void = F.lit("8000")
        word = lambda i: F.coalesce(
            F.lpad(F.hex(F.pmod(F.col("heights")[i], F.lit(65536))), 4, "0"), void)
        text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), word), "")
        side = lambda c, pos, neg: F.when(F.col(c) < 0, neg).otherwise(pos)
        number = lambda c, width: F.lpad(F.abs(c).cast("string"), width, "0")
        name = F.concat(side("lat0", "N", "S"), number("lat0", 2),
                        side("lon0", "E", "W"), number("lon0", 3), F.lit(".hgt"))
        return files.select(name.alias("path"), F.unhex(text).alias("content"))


def _degrees(number: Column, span: int, name: str = "lat") -> Column:
    """A whole number folded into -span/2 .. span/2 thousandths of a degree."""
    folded = (number % span - span // 2).cast("double")
    return (folded / F.lit(1000.0)).alias(name)


def _milli(name: str) -> Column:
    return F.col(name).cast("decimal(9,3)").cast("string")


def _csv(*parts) -> Column:
    return F.concat_ws(",", *parts).alias("line")
