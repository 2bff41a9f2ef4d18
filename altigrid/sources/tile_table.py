"""Tables that are updated in place: only the key ranges that changed are rewritten.

A tile table is partitioned by ``zoom`` and ``band``, an interval of 2,048 tile
codes (256 MiB of elevation rasters at most), and sorted by code in it; zooms up to
5 are one band each. Files carry statistics of ``code`` and Bloom filters of
``geohash`` for row groups of some 64 rasters. A point table is partitioned by
the first two characters of its key, 1,024 ranges at most.

New content of a partition is staged beside the table and moved in at the end of the
job, so a run that fails leaves all partitions as they were. Lists of touched
partitions are the only thing that reaches the driver; they are no longer than
the table's own list of folders.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from altigrid.functions.grid import BAND_BITS, band_of, tile_code
from altigrid.operators import gps, rasters
from altigrid.operators.joins import split_join
from altigrid.operators.pixels import pixel_max
from altigrid.operators.serving import box_blocks, tiles_in_bbox
from altigrid.operators.tiles import pack_tiles
from altigrid.sources.store import drop_at_exit, scratch_path

BANDED_SCHEMA = "geohash string, tile_x int, tile_y int, code bigint, tile binary, zoom int, band int"
POINT_SCHEMA = "geohash string, value int, prefix string"
TILES_PER_FILE = 2048
ROW_GROUP_BYTES = 8 << 20
INTERVALS = 64

_TILE = ["zoom", "geohash", "tile_x", "tile_y", "tile"]


def _write(tiles: DataFrame, path: str, dynamic: bool, ranged: bool = False) -> None:
    code = tile_code(F.col("tile_x"), F.col("tile_y"))
    placed = tiles.select(*_TILE, code.alias("code")).withColumn("band", band_of(F.col("code")))
    # One task for each band, unless the rasters lie in ranges of the key already: then
    # they stay where they were packed, and a band has a file for each range in it.
    dealt = placed if ranged else placed.repartition("zoom", "band")
    (
        dealt.sortWithinPartitions("zoom", "band", "code")
        .write.mode("overwrite").partitionBy("zoom", "band")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("maxRecordsPerFile", TILES_PER_FILE)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#geohash", "true")
        .parquet(path)
    )


def write_tile_table(tiles: DataFrame, path: str, ranged: bool = False) -> None:
    """Create the table, or drop and recreate it, with these tiles; ranged: as :func:`pack_tiles` ranges them."""
    _write(tiles, path, False, ranged)


def replace_bands(tiles: DataFrame, path: str) -> None:
    """Replace the bands that occur in `tiles`, which holds all that they shall contain."""
    _write(tiles, path, True)


def read_tile_table(spark: SparkSession, path: str) -> DataFrame:
    """Filters on zoom and band prune folders, on code row groups."""
    return spark.read.schema(BANDED_SCHEMA).parquet(path)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def in_bands(touched: Iterable[tuple[int, int]]) -> Column:
    """Rows of the given (zoom, band) folders, as a filter that prunes them."""
    bands: dict[int, list[int]] = {}
    for zoom, band in touched:
        bands.setdefault(zoom, []).append(band)
    return any_of((F.col("zoom") == z) & F.col("band").isin(b) for z, b in sorted(bands.items()))


def roll_up_table(spark: SparkSession, path: str, max_zoom: int, min_zoom: int = 0) -> None:
    """Write all zooms below max_zoom of a tile table from its finest one.

    Some levels at a time, each step from the tiles that the one before wrote.
    """
    zoom = max_zoom
    while zoom > min_zoom:
        levels = min(rasters.BLOCK_LEVELS, zoom - min_zoom)
        finest = read_tile_table(spark, path).where(F.col("zoom") == zoom)
        replace_bands(rasters.rollup_tiles(finest, zoom, levels), path)
        zoom -= levels


def finest_tiles(readings: DataFrame, zoom: int) -> DataFrame:
    """Packed tiles of one zoom in ranges of their key: readings cross one exchange, pixels a second one, rasters none."""
    return pack_tiles(pixel_max(readings, zoom), ranged=["geohash"])


def build_tile_table(spark: SparkSession, finest: DataFrame, path: str, max_zoom: int, min_zoom: int = 0) -> None:
    """Tiles of :func:`finest_tiles` and all their ancestors as a new table."""
    write_tile_table(finest, path, ranged=True)
    roll_up_table(spark, path, max_zoom, min_zoom)


def update_tile_table(spark: SparkSession, finest: DataFrame, path: str, max_zoom: int, min_zoom: int = 0) -> list[tuple[int, int]]:
    """Put new tiles of max_zoom over a stored pyramid; returns the (zoom, band) that were rewritten.

    The highest altitude of old and new readings is the higher of both, at every
    zoom. So the new tiles get a small pyramid of their own, and each of its tiles is
    merged with the stored one; other tiles of a touched band are copied, other
    bands are not read.
    """
    staged = scratch_path(spark, "new-tiles")
    build_tile_table(spark, finest, staged, max_zoom, min_zoom)
    drop_at_exit(spark, staged)
    new = read_tile_table(spark, staged)
    touched = sorted((r.zoom, r.band) for r in new.select("zoom", "band").distinct().toLocalIterator())
    if touched:
        old = read_tile_table(spark, path).where(in_bands(touched))
        replace_bands(rasters.merge_tiles(old, new), path)
    return touched


# --- looking up ---------------------------------------------------------------

def covering(codes: DataFrame, most: int = INTERVALS) -> list[tuple[int, int, int]]:
    """At most about `most` intervals (zoom, first, last) that hold all of those in `codes`.

    One pass estimates how many groups each length of prefix gives; the longest
    prefix that gives few enough is taken.
    """
    widths = range(0, 40, 2)
    count = lambda s: F.approx_count_distinct(F.struct("zoom", F.shiftright("first", s)), 0.03).alias(f"w{s}")
    found = codes.agg(*[count(s) for s in widths]).first()
    width = next((s for s in widths if found[f"w{s}"] <= most), widths[-1])
    spans = codes.groupBy("zoom", F.shiftright("first", width).alias("_at")).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return sorted((r.zoom, r.first, r.last) for r in spans.select("zoom", "first", "last").toLocalIterator())


def in_intervals(intervals: Sequence[tuple[int, int, int]]) -> Column:
    """A filter that prunes folders by zoom and band, and row groups by code."""
    def one(zoom: int, first: int, last: int) -> Column:
        bands = F.col("band").between(first >> BAND_BITS, last >> BAND_BITS)
        return (F.col("zoom") == zoom) & bands & F.col("code").between(first, last)

    return any_of(one(*i) for i in intervals)


def lookup_tiles(requests: DataFrame, tiles: DataFrame, columns: Sequence[str] = ("geohash", "tile"),
                 most: int = INTERVALS) -> DataFrame:
    """The stored tile of each request (zoom, tile_x, tile_y): `columns` of it, null if there is none.

    The requests' keys become a few intervals, which are all that is read of the
    table; the join then decides.
    """
    spark = requests.sparkSession
    keyed = requests.withColumn("code", tile_code(F.col("tile_x"), F.col("tile_y")))
    # One pass over the requests: the distinct keys, their intervals and the hot ones among
    # them come from the stored counts, whose size the planner knows when they meet the tiles.
    path = scratch_path(spark, "wanted")
    counts = keyed.groupBy("zoom", "code").agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(path)
    drop_at_exit(spark, path)
    counts = spark.read.schema(counts.schema).parquet(path)
    wanted = counts.select("zoom", "code")
    near = tiles.where(in_intervals(covering(wanted.select("zoom", F.col("code").alias("first"), F.col("code").alias("last")), most)))
    asked = near.select("zoom", "code", *columns).join(wanted, ["zoom", "code"], "left_semi")
    return split_join(keyed, asked, ["zoom", "code"], "left", counts=counts).drop("code")


def tiles_in_boxes(requests: DataFrame, tiles: DataFrame, most: int = INTERVALS) -> DataFrame:
    """Stored tiles in each request's box at its zoom; reads only the intervals of codes that the boxes touch.

    A box is cut into at most 64 blocks of 2 ** k tiles a side, each an interval of codes.
    """
    corner = lambda c: F.call_function("shiftleft", F.col(c), F.col("_up"))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * F.col("_up"))
    blocks = box_blocks(requests).select("zoom", "_up", tile_code(corner("_bx"), corner("_by")).alias("first"))
    near = tiles.where(in_intervals(covering(blocks.select("zoom", "first", (F.col("first") + size - 1).alias("last")), most)))
    return tiles_in_bbox(requests, near.drop("code", "band"))


# --- points -------------------------------------------------------------------

def _with_prefix(points: DataFrame) -> DataFrame:
    return points.select("geohash", "value", F.substring("geohash", 1, 2).alias("prefix"))


def _write_points(points: DataFrame, path: str, dynamic: bool) -> None:
    (
        _with_prefix(points).repartition("prefix").sortWithinPartitions("prefix", "geohash")
        .write.mode("overwrite").partitionBy("prefix")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)
    )


def write_point_table(points: DataFrame, path: str) -> None:
    """Key-value rows (geohash, value) as a new table."""
    _write_points(points, path, False)


def read_point_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINT_SCHEMA).parquet(path)


def upsert_point_table(spark: SparkSession, updates: DataFrame, path: str) -> list[str]:
    """Put rows over those stored under the same key; returns the prefixes that were rewritten."""
    touched = sorted(r.prefix for r in _with_prefix(updates).select("prefix").distinct().toLocalIterator() if r.prefix is not None)
    if touched:
        old = read_point_table(spark, path).where(F.col("prefix").isin(touched)).drop("prefix")
        _write_points(gps.merge_points(old, updates.where("geohash IS NOT NULL").select("geohash", "value")), path, True)
    return touched
