"""Whole rasters: roll-up, merging, colouring, visit counts, without a row per pixel.

Rasters are numpy arrays inside tasks, read and written in Arrow batches. An
elevation raster holds 16-bit words of which 0 is no data and a larger word a
greater altitude, so the maximum of words is that of altitudes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from altigrid.functions import palette as ramps
from altigrid.functions.geohash import tile_geohash
from altigrid.functions.grid import TILE_SIDE, tile_code
from altigrid.operators.tiles import ALTITUDE_SHIFT, TILE_PIXELS, fill_words, into_word, tile_pixels

# Levels that one block rolls up: it holds 4 ** 5 quarters of 32 KiB at most.
BLOCK_LEVELS = 5
_KEYS = ["zoom", "geohash", "tile_x", "tile_y"]
_HALF = TILE_SIDE // 2
_ROWS = 32  # rasters of one Arrow batch that leaves a task


def _array(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, TILE_SIDE, TILE_SIDE)


def halved(rasters: np.ndarray) -> np.ndarray:
    """Each 2 x 2 square becomes its greatest word."""
    top = np.maximum(rasters[:, ::2, ::2], rasters[:, 1::2, ::2])
    return np.maximum(top, np.maximum(rasters[:, ::2, 1::2], rasters[:, 1::2, 1::2]))


def _even_bits(code: int) -> int:
    return sum((code >> 2 * k & 1) << k for k in range(20))


class _Ancestors:
    """Rasters being filled, one for each level above; tiles come in the order of their code."""

    def __init__(self, zoom: int, levels: int):
        self.zoom, self.levels = zoom, levels
        self.codes: list[int | None] = [None] * (levels + 1)
        self.rasters = np.zeros((levels + 1, TILE_SIDE, TILE_SIDE), "<u2")

    def add(self, level: int, code: int, half: np.ndarray) -> Iterator[tuple]:
        """Place the half of a tile in its parent, `level` above; yield what that completes."""
        if self.codes[level] is not None and self.codes[level] != code >> 2:
            yield from self.close(level)
        if self.codes[level] is None:
            self.codes[level] = code >> 2
            self.rasters[level] = 0
        x, y = _HALF * (code & 1), _HALF * (code >> 1 & 1)
        self.rasters[level, x:x + _HALF, y:y + _HALF] = half

    def close(self, level: int) -> Iterator[tuple]:
        code = self.codes[level]
        self.codes[level] = None
        yield self.zoom - level, _even_bits(code), _even_bits(code >> 1), self.rasters[level].tobytes()
        if level < self.levels:
            yield from self.add(level + 1, code, halved(self.rasters[level][None])[0])

    def rest(self) -> Iterator[tuple]:
        for level in range(1, self.levels + 1):
            if self.codes[level] is not None:
                yield from self.close(level)


def _in_batches(rows: Iterator[tuple], types: Sequence[pa.DataType], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))


def rollup_tiles(tiles: DataFrame, zoom: int, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Tiles of the `levels` zooms above, each pixel the highest of the four below it.

    tiles: (tile_x, tile_y, tile) of one zoom, one row per tile. Each is halved
    where it is; the quarters, a fourth of the bytes, are shuffled once, by the
    ancestor `levels` above, and come in the order of their code. A task then holds
    one raster per level: a parent is done when the code leaves it.
    """
    if not 1 <= levels <= min(BLOCK_LEVELS, zoom):
        raise ValueError(f"levels must be 1..{min(BLOCK_LEVELS, zoom)}")

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                halves = halved(_array(part.column("tile"), "<u2"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("code"), pa.array([h.tobytes() for h in halves], pa.binary())], names=["code", "half"])

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = _Ancestors(zoom, levels)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for code, half in zip(batch.column("code").to_pylist(), batch.column("half").to_pylist()):
                    yield from above.add(1, code, np.frombuffer(half, "<u2").reshape(_HALF, _HALF))
            yield from above.rest()

        yield from _in_batches(rows(), [pa.int32(), pa.int32(), pa.int32(), pa.binary()], ["zoom", "tile_x", "tile_y", "tile"])

    quarters = tiles.select(tile_code(F.col("tile_x"), F.col("tile_y")).alias("code"), "tile").mapInArrow(halve, "code long, half binary")
    blocks = quarters.repartition(F.shiftright("code", 2 * levels)).sortWithinPartitions("code")
    return _keyed(blocks.mapInArrow(roll, "zoom int, tile_x int, tile_y int, tile binary"))


def _keyed(rasters: DataFrame) -> DataFrame:
    key = tile_geohash(F.col("zoom"), F.col("tile_x"), F.col("tile_y"))
    return rasters.select("zoom", key.alias("geohash"), "tile_x", "tile_y", "tile")


def _merge(old: DataFrame, new: DataFrame, kind: str, both: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """One tile per key of either side; where both have one, `both` of the arrays.

    A key has a row on each side at most. Only keys on both sides reach Python.
    """
    sides = old.select(*_KEYS, F.col("tile").alias("a"), F.lit(None).cast("binary").alias("b")).unionByName(
        new.select(*_KEYS, F.lit(None).cast("binary").alias("a"), F.col("tile").alias("b")))
    met = sides.groupBy(*_KEYS).agg(F.max("a").alias("a"), F.max("b").alias("b"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                out = [both(np.frombuffer(x, kind), np.frombuffer(y, kind)).astype(kind).tobytes() if x is not None and y is not None else x or y for x, y in zip(a, b)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in _KEYS], pa.array(out, pa.binary())], names=[*_KEYS, "tile"])

    return met.mapInArrow(merge, "zoom int, geohash string, tile_x int, tile_y int, tile binary")


def merge_tiles(old: DataFrame, new: DataFrame) -> DataFrame:
    """Elevation tiles of both sides, the higher altitude per pixel."""
    return _merge(old, new, "<u2", np.maximum)


# --- colours ----------------------------------------------------------------

def colour_table(palette: str | Sequence[ramps.Stop] = "gps") -> np.ndarray:
    """Red, green, blue, alpha of each of the 65,536 words; no data is transparent."""
    stops = ramps.palette_stops(palette)
    out = np.zeros((1 << 16, 4), np.uint8)
    out[1:, 3] = 255
    if stops:
        share = (np.arange(1 << 16, dtype=np.float64) - ALTITUDE_SHIFT + 8000.0) / 16000.0
        right, left = np.array([*stops, stops[-1]]), np.array([stops[0], *stops[:-1], stops[-1]])
        at = np.searchsorted(np.array(stops)[:, 0], share, side="right")
        span = (left - right)[:, 0]
        part = (share - right[at, 0]) / np.where(span == 0, 1.0, span)[at]
        for c in range(3):
            change = np.where(span == 0, 0.0, (left - right)[:, c + 1])
            out[1:, c] = np.rint((change[at] * part + right[at, c + 1]) * 255.0)[1:]
    return out


def tile_rgba_stored(tiles: DataFrame, palette: str | Sequence[ramps.Stop] = "gps") -> DataFrame:
    """Packed tiles as RGBA rasters, row-major from the north-west: one look-up per word."""
    colours = colour_table(palette)

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                words = _array(part.column("tile"), "<u2").transpose(0, 2, 1)[:, ::-1]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in _KEYS], pa.array([colours[w].tobytes() for w in words], pa.binary())], names=[*_KEYS, "raster"])

    return tiles.select(*_KEYS, "tile").mapInArrow(paint, "zoom int, geohash string, tile_x int, tile_y int, raster binary")


# --- visits -----------------------------------------------------------------

MOST_VISITS = (1 << 32) - 1


def pack_visits(visits: DataFrame, ranged: bool = False) -> DataFrame:
    """Visits (zoom, gx, gy, n) as tiles of unsigned 32-bit counts at x * 256 + y, held at the largest one."""
    pos = F.col("x") * TILE_SIDE + F.col("y")
    count = F.least(F.col("n"), F.lit(MOST_VISITS))
    # Low byte first, as in the elevation tiles.
    byte = lambda k: F.shiftleft(F.shiftright(count, 8 * k).bitwiseAND(F.lit(255)), 24 - 8 * k)
    words = tile_pixels(visits.select("zoom", "gx", "gy", F.col("n").cast("long").alias("n")), ranged, "n").select(
        *_KEYS, F.shiftright(pos, 1).alias("at"),
        into_word(byte(0) + byte(1) + byte(2) + byte(3), F.col("y").bitwiseAND(F.lit(1)), 32).alias("part"))
    return fill_words(words, _KEYS, TILE_PIXELS // 2, "tile")


def merge_visits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Visit tiles of both sides, counts added and held at the largest one."""
    add = lambda a, b: np.minimum(a.astype(np.uint64) + b, MOST_VISITS)
    return _merge(old, new, "<u4", add)


def unpack_visits(tiles: DataFrame) -> DataFrame:
    """Visit tiles back to (zoom, gx, gy, n), pixels without visits left out."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                counts = _array(row.column("tile"), "<u4")[0]
                x, y = np.nonzero(counts)
                zoom, tx, ty = (row.column(c)[0].as_py() for c in ("zoom", "tile_x", "tile_y"))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), zoom, np.int32)), pa.array((tx * TILE_SIDE + x).astype(np.int32)),
                    pa.array((ty * TILE_SIDE + y).astype(np.int32)), pa.array(counts[x, y].astype(np.int64)),
                ], names=["zoom", "gx", "gy", "n"])

    return tiles.select("zoom", "tile_x", "tile_y", "tile").mapInArrow(unpack, "zoom int, gx int, gy int, n long")


def visit_peaks(tiles: DataFrame) -> DataFrame:
    """Per zoom the count of its busiest pixel, read from the rasters: one short row per tile."""

    def peak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [int(np.frombuffer(t, "<u4").max()) for t in batch.column("tile").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("zoom"), pa.array(most, pa.int64())], names=["zoom", "n"])

    found = tiles.select("zoom", "tile").mapInArrow(peak, "zoom int, n long")
    return found.groupBy("zoom").agg(F.max("n").alias("peak"))
