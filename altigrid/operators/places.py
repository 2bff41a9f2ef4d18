"""Cities with their region, one per key, as wide rows or as cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from altigrid.functions.geohash import CITY_KEY_LENGTH, geohash

# Column names of a city's stored cells.
COUNTRY_CELL, CITY_CELL, POPULATION_CELL = "C", "c", "p"


def join_regions(cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Inner join on (country, region), both with the country in upper case.

    The planner broadcasts the regions if their bytes allow, and else splits
    regions with many cities while it runs.
    """
    return cities.join(regions, ["country", "region"])


def city_by_geohash(cities: DataFrame, length: int = CITY_KEY_LENGTH) -> DataFrame:
    """One city per geohash: the most populous, ties to the last by name.

    Input: joined cities (city, population, name, lat, lon); ``name`` is the
    region's name, stored as the city's country.
    """
    key = geohash(F.col("lat"), F.col("lon"), length)
    rank = F.struct("population", "city", F.col("name").alias("country"))
    best = cities.groupBy(key.alias("geohash")).agg(F.max(rank).alias("best"))
    return best.select("geohash", "best.city", "best.population", "best.country")


def city_cells(cities: DataFrame) -> DataFrame:
    """Cells (geohash, qualifier, value) of keyed cities: three per row."""
    return cities.select(
        "geohash",
        F.stack(
            F.lit(3),
            F.lit(COUNTRY_CELL), F.col("country"),
            F.lit(CITY_CELL), F.col("city"),
            F.lit(POPULATION_CELL), F.col("population").cast("string"),
        ).alias("qualifier", "value"),
    )


def cells_wide(cells: DataFrame) -> DataFrame:
    """Cells back to one row per key."""
    at = lambda q: F.max(F.when(F.col("qualifier") == q, F.col("value")))
    return cells.groupBy("geohash").agg(
        at(CITY_CELL).alias("city"),
        at(POPULATION_CELL).try_cast("bigint").alias("population"),
        at(COUNTRY_CELL).alias("country"),
    )


def scan_not_missing(df: DataFrame, column: str, pattern: str = ".*") -> DataFrame:
    """Keep rows whose column exists and matches a pattern."""
    return df.where(F.col(column).isNotNull() & F.col(column).cast("string").rlike(pattern))
