"""GPS points: visits, centroids, duplicates, key-value upserts, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from altigrid.functions.geohash import POINT_KEY_LENGTH, geohash
from altigrid.operators.pixels import assign_pixels

# Multiplier and modulus of multiplicative hashing on 32 bits.
_HASH_FACTOR = 2654435761
_HASH_RANGE = 2**32
_ID_RANGE = 2**31 - 1


def gps_pixels(points: DataFrame, zoom: int) -> DataFrame:
    """Visits per pixel with their centroid: (zoom, gx, gy, n, lat, lon)."""
    visits = assign_pixels(points, zoom).groupBy("gx", "gy").agg(
        F.count(F.lit(1)).alias("n"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    return visits.select(F.lit(zoom).alias("zoom"), "*")


def gps_dedupe(points: DataFrame) -> DataFrame:
    """Distinct coordinates with the number of points on each."""
    return points.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))


def gps_heat(points: DataFrame, zoom: int) -> DataFrame:
    """Visits per pixel and their share of the busiest pixel of the zoom (0..1)."""
    visits = assign_pixels(points, zoom).groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("n"))
    return heat_of(visits.select(F.lit(zoom).alias("zoom"), "*"))


def heat_of(visits: DataFrame) -> DataFrame:
    """Counted visits (zoom, gx, gy, n) of one zoom with their share of the busiest pixel."""
    peak = visits.agg(F.max("n")).scalar()
    return visits.select("zoom", "gx", "gy", "n", (F.col("n") / peak).alias("heat"))


def points_upsert(points: DataFrame, order_col: str) -> DataFrame:
    """Key-value view of points: the last value by ``order_col`` wins per key.

    Key: geohash of 6 characters; value: lat + lon without its fraction.
    """
    value = (F.col("lat") + F.col("lon")).cast("int")
    key = geohash(F.col("lat"), F.col("lon"), POINT_KEY_LENGTH)
    return points.groupBy(key.alias("geohash")).agg(F.max_by(value, order_col).alias("value"))


def merge_points(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored key-value rows with new ones put over them; both have one row per key."""
    kept = stored.join(updates.select("geohash"), "geohash", "left_anti")
    return kept.unionByName(updates)


def geohash_groups(points: DataFrame, length: int = 8) -> DataFrame:
    """Points per geohash: count, lowest, highest and mean height."""
    key = geohash(F.col("lat"), F.col("lon"), length)
    return points.groupBy(key.alias("geohash")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("height").alias("min_height"), F.max("height").alias("max_height"),
        F.avg("height").alias("mean_height"))


def sample_bernoulli(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Independent draw of each row, without replacement."""
    return df.sample(False, fraction, seed)


def sample_hash(df: DataFrame, fraction: float, id_col: str) -> DataFrame:
    """Repeatable sample: the same ids on every run, cluster and partitioning."""
    folded = F.pmod(F.col(id_col).cast("bigint"), F.lit(_ID_RANGE).cast("bigint"))
    hashed = F.pmod(folded * F.lit(_HASH_FACTOR), F.lit(_HASH_RANGE))
    return df.where(hashed < F.lit(int(fraction * _HASH_RANGE)))
