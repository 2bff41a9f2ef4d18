"""Gazetteer files: cities and region codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from altigrid.functions.text import parse_rows, to_double, to_integer
from altigrid.sources.points import COMPAT, STRICT

# Fixed value: header of the cities file.
CITY_FIELDS = ("country", "city", "accent_city", "region", "population", "lat", "lon")


def parse_cities(lines: DataFrame, keep_missing: bool = False) -> DataFrame:
    """(country, region, city, population, lat, lon); country in upper case.

    Lines that do not parse vanish: the header, short lines, and cities without
    a population unless ``keep_missing``.
    """
    def fields(at) -> dict[str, Column]:
        return {
            "country": F.upper(at(0)),
            "region": at(3),
            "city": at(2),
            "population": to_integer(at(4), "bigint"),
            "lat": to_double(at(5)),
            "lon": to_double(at(6)),
        }

    needed = ["country", "region", "city", "population", "lat", "lon"]
    if keep_missing:
        needed.remove("population")
    return parse_rows(lines, fields, needed)


def parse_cities_wide(lines: DataFrame) -> DataFrame:
    """All seven fields; missing text is null, a missing number 0."""
    def fields(at) -> dict[str, Column]:
        text = {name: at(i) for i, name in enumerate(CITY_FIELDS)}
        return text | {
            "population": F.coalesce(to_integer(text["population"]), F.lit(0)),
            "lat": F.coalesce(to_double(text["lat"]), F.lit(0.0)),
            "lon": F.coalesce(to_double(text["lon"]), F.lit(0.0)),
        }

    return parse_rows(lines, fields, [])


def parse_regions(lines: DataFrame, mode: str = STRICT) -> DataFrame:
    """(country, region, name); country in upper case.

    strict reads quoted csv, so that a name may hold commas, and drops short
    lines. compat cuts at every comma and strips the first and last character.
    """
    if mode == COMPAT:
        def fields(at) -> dict[str, Column]:
            name = at(2)
            inner = F.substring(name, F.lit(2), F.greatest(F.length(name) - 2, F.lit(0)))
            return {"country": F.upper(at(0)), "region": at(1), "name": inner}

        return parse_rows(lines, fields, ["country", "region", "name"])
    if mode != STRICT:
        raise ValueError(f"unknown mode {mode!r}")
    row = F.from_csv("line", "country string, region string, name string", {"quote": '"'})
    parsed = lines.select(row.alias("row")).select("row.*")
    return parsed.withColumn("country", F.upper("country")).dropna()


def region_hex_code(regions: DataFrame) -> DataFrame:
    """Add ``code``: the region as a number where it is two hex digits, else null.

    Codes may hold other letters, so the join key stays the string.
    """
    two_hex = F.col("region").rlike("^[0-9A-Fa-f]{2}$")
    code = F.when(two_hex, F.conv("region", 16, 10).try_cast("int"))
    return regions.withColumn("code", code)
