"""Tables on shared storage: tiles, pixels, cells, text exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TILE_SCHEMA = "geohash string, tile_x int, tile_y int, tile binary, zoom int"
PIXEL_SCHEMA = "gx int, gy int, alt int, zoom int"
CHECKPOINT_KEY = "spark.checkpoint.dir"
# A tile is 128 KiB: files of about 1 GiB before compression.
TILES_PER_FILE = 8192


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A session with one process (``local[...]``) and without the setting uses its
    warehouse folder.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch table when the session's process ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def write_by_zoom(
    table: DataFrame, path: str, order: list[str], mode: str = "overwrite",
    only_given_zooms: bool = False, rows_per_file: int | None = None,
) -> None:
    """Write a table partitioned by zoom, its rows in total order of (zoom, order).

    ``only_given_zooms`` replaces just the zooms present in ``table``; otherwise
    an overwrite recreates the whole table.
    """
    keys = ["zoom", *order]
    writer = (
        table.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if only_given_zooms else "static")
        .partitionBy("zoom")
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_tiles(tiles: DataFrame, path: str, mode: str = "overwrite",
                only_given_zooms: bool = False) -> None:
    """Write packed tiles in key order."""
    columns = tiles.select("zoom", "geohash", "tile_x", "tile_y", "tile")
    write_by_zoom(columns, path, ["geohash"], mode, only_given_zooms, TILES_PER_FILE)


def write_sorted_tiles(tiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write tiles that :func:`altigrid.operators.tiles.pack_tiles` ranged by key.

    Their partitions are key ranges already: rows are only sorted in place and
    the blobs never cross the network.
    """
    (
        tiles.select("zoom", "geohash", "tile_x", "tile_y", "tile")
        .sortWithinPartitions("zoom", "geohash")
        .write.mode(mode)
        .option("maxRecordsPerFile", TILES_PER_FILE)
        .partitionBy("zoom")
        .parquet(path)
    )


def create_tile_table(spark: SparkSession, path: str) -> None:
    """Create the tile table empty, or drop and recreate it."""
    spark.createDataFrame([], TILE_SCHEMA).write.mode("overwrite").partitionBy("zoom").parquet(path)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Tiles; filters on ``zoom`` prune folders, on ``geohash`` reach the scan."""
    return spark.read.schema(TILE_SCHEMA).parquet(path)


def write_pixels(pixels: DataFrame, path: str) -> None:
    """Write the long form of a pyramid (one row per pixel).

    The rebalance hint lets the adaptive planner split the big zooms and join
    the small ones, so that no zoom is one task and none is many tiny files.
    """
    columns = pixels.select("zoom", "gx", "gy", "alt").hint("rebalance", "zoom")
    columns.write.mode("overwrite").partitionBy("zoom").parquet(path)


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PIXEL_SCHEMA).parquet(path)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one text column as text files."""
    lines.select("line").write.mode(mode).text(path)
