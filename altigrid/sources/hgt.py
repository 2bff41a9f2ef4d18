"""Binary elevation grids (``N45W066.hgt``): n x n big-endian 16-bit heights.

A file is cut into its grid rows on the JVM side, so that an Arrow batch holds
rows of a few kilobytes and never whole files, whatever the batch setting of
the session is. Only the decoding of a row runs in Python, on numpy arrays.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from altigrid.functions.text import with_significant_text
from altigrid.sources.points import COMPAT, STRICT

GRID_SIDE = 1201
# Heights along a side of a file, for steps of three seconds and of one.
KNOWN_SIDES = (1201, 3601)
VOID = -32768
_NAME_LENGTH = 11  # N45W066.hgt
_ROWS_PER_BATCH = 64


def read_hgt_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` as (path, content)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[hH][gG][tT]")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )


def _grid_rows(files: DataFrame, n: int | None) -> DataFrame:
    """(lat0, lon0, n, row, heights): files cut into rows; without n its length tells a file's side."""
    name = F.substring("path", -_NAME_LENGTH, _NAME_LENGTH)

    def corner(sign_at: int, digits: int, negative: str):
        sign = F.when(F.upper(F.substring(name, sign_at, 1)) == negative, -1.0).otherwise(1.0)
        return F.substring(name, sign_at + 1, digits).try_cast("double") * sign

    length = F.length("content")
    by_length = F.coalesce(*[F.when(length == 2 * side * side, side) for side in KNOWN_SIDES])
    side = by_length if n is None else F.lit(n)
    expected = F.coalesce(2 * side * side, F.lit(2 * max(KNOWN_SIDES) ** 2))
    named = name.rlike("^[nsNS][0-9]{2}[ewEW][0-9]{3}[.][hH][gG][tT]$")
    fault = (
        F.when(~named, "elevation file without a corner in its name: ")
        .when(length < expected, "truncated elevation file: " if n is not None else "elevation file of no known grid size: ")
        .when(length > expected, "elevation file of another grid size: "))
    whole = F.when(fault.isNull(), F.col("content")).otherwise(F.raise_error(F.concat(fault, F.col("path"))))
    cut = files.select(
        corner(1, 2, "S").alias("lat0"),
        corner(4, 3, "W").alias("lon0"),
        whole.alias("content"),
        # A faulty file has one row, which raises the error.
        F.coalesce(side, F.lit(1)).alias("n"),
        F.explode(F.sequence(F.lit(0), F.coalesce(side, F.lit(1)) - 1)).alias("row"),
    )
    heights = F.substring(F.col("content"), F.col("row") * 2 * F.col("n") + 1, 2 * F.col("n"))
    return cut.select("lat0", "lon0", "n", "row", heights.alias("heights"))


def decode_hgt(
    files: DataFrame,
    n: int | None = GRID_SIDE,
    mode: str = STRICT,
    min_height: int | None = 1,
    drop_shared_edge: bool = False,
) -> DataFrame:
    """Points (lat, lon, height) of elevation files (path, content).

    n is the heights along a side; None takes it from each file's length.

    strict: row 0 is the north edge and both steps are ``1 / (n - 1)``; the
    last row and column repeat the next file's first ones, which
    ``drop_shared_edge`` removes before counts and means.
    compat: row 0 is the south edge, steps are ``1 / n`` and ``.001 / n``.
    Voids are never points; ``min_height=None`` keeps every other height.
    """
    if mode not in (STRICT, COMPAT):
        raise ValueError(f"unknown mode {mode!r}")
    north_up = mode == STRICT
    floor = VOID + 1 if min_height is None else min_height

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sides = np.asarray(whole.column("n"))
            for n, start in ((int(n), s) for n in np.unique(sides) for s in range(0, int((sides == n).sum()), _ROWS_PER_BATCH)):
                lat_step, lon_step = (1.0 / (n - 1), 1.0 / (n - 1)) if north_up else (1.0 / n, 0.001 / n)
                south_row = n - 1 if north_up else 0
                lon_offsets = np.arange(n) * lon_step
                batch = whole if (sides == n).all() else whole.filter(pa.array(sides == n))
                part = batch.slice(start, _ROWS_PER_BATCH)
                raw = b"".join(part.column("heights").to_pylist())
                grid = np.frombuffer(raw, dtype=">i2").reshape(-1, n)
                row = part.column("row").to_numpy()
                keep = grid >= floor
                if drop_shared_edge:
                    keep[:, -1] = False
                    keep[row == south_row] = False
                r, c = np.nonzero(keep)
                steps = (n - 1 - row if north_up else row) * lat_step
                lat = part.column("lat0").to_numpy() + steps
                lon = part.column("lon0").to_numpy()[r] + lon_offsets[c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lat[r]), pa.array(lon), pa.array(grid[r, c].astype(np.int32))],
                    names=["lat", "lon", "height"])

    return _grid_rows(files, n).mapInArrow(decode, "lat double, lon double, height int")


def read_hgt(spark: SparkSession, path: str, n: int | None = None, mode: str = STRICT,
             min_height: int | None = 1, drop_shared_edge: bool = False) -> DataFrame:
    """Points of every elevation file under ``path``."""
    return decode_hgt(read_hgt_files(spark, path), n, mode, min_height, drop_shared_edge)


def encode_hgt(readings: DataFrame, n: int = GRID_SIDE) -> DataFrame:
    """Elevation files (path, content) of points (lat, lon, height), one per degree cell that has any.

    Row 0 is the north edge, a grid cell holds its highest point, the others are
    void. Points are first reduced to grid cells, so a file comes from n * n rows at most.
    """
    lat0, lon0 = F.floor("lat"), F.floor("lon")
    cell = lambda deg, low: F.floor((F.col(deg) - low) * F.lit(float(n - 1))).cast("int")
    highest = readings.groupBy(
        lat0.cast("int").alias("lat0"), lon0.cast("int").alias("lon0"),
        ((F.lit(n - 1) - cell("lat", lat0)) * n + cell("lon", lon0)).alias("at"),
    ).agg(F.max("height").alias("height"))

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        lat, lon = (k.as_py() for k in key)
        grid = np.full(n * n, VOID, ">i2")
        grid[np.asarray(table.column("at"))] = np.asarray(table.column("height"))
        name = f"{'S' if lat < 0 else 'N'}{abs(lat):02d}{'W' if lon < 0 else 'E'}{abs(lon):03d}.hgt"
        return pa.table({"path": pa.array([name]), "content": pa.array([grid.tobytes()], pa.binary())})

    return highest.groupBy("lat0", "lon0").applyInArrow(fill, "path string, content binary")


def write_hgt_files(files: DataFrame, path: str) -> int:
    """Write (path, content) rows as files of these names below a folder; returns how many.

    Each task writes a file under a name of its own and then renames it, so no reader sees half
    a file and a repeated task writes the same one again. The folder is one that
    pyarrow's file systems reach from all executors.
    """
    folder = re.sub(r"^file:/+", "/", path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remote, below = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                remote.create_dir(below, recursive=True)
                part = f"{below}/.{name}.{uuid.uuid4().hex}"
                with remote.open_output_stream(part, compression=None) as out:
                    out.write(content)
                remote.move(part, f"{below}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select("path", "content").mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def points_to_text(points: DataFrame) -> DataFrame:
    """``lat,lng,height`` lines with 10 significant digits."""
    text = with_significant_text(points, ["lat", "lon"])
    return text.select(F.concat_ws(",", "lat", "lon", F.col("height").cast("string")).alias("line"))
