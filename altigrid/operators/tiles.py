"""Dense binary tiles: 256 x 256 pixels packed into one value, and back.

An elevation tile holds unsigned 16-bit little-endian words at position
``x * 256 + y`` (y to the north); 0 means no data, else altitude + 32769.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from altigrid.functions import grid, palette as ramps
from altigrid.functions.geohash import tile_geohash
from altigrid.functions.grid import TILE_SIDE

TILE_PIXELS = TILE_SIDE * TILE_SIDE
TILE_BYTES = 2 * TILE_PIXELS
# Fixed value: altitude 0 is stored as 32769.
ALTITUDE_SHIFT = 32769

_KEYS = ["zoom", "geohash", "tile_x", "tile_y"]
# Words that travel together while a tile is packed.
_RUN = 4


def tile_pixels(pixels: DataFrame, ranged: bool | Sequence[str], measure: str = "alt") -> DataFrame:
    """Pixels with their tile key, all pixels of a tile in one partition.

    ``ranged`` places tiles by ranges of the table's key, so that packed tiles
    can be written in total order without moving them again. Pixels of a single zoom are
    ranged by ``["geohash"]``: the planner drops a constant zoom from the grouping, which
    ranges of (zoom, geohash) then do not serve.
    """
    zoom, gx, gy = F.col("zoom"), F.col("gx"), F.col("gy")
    tx, ty = grid.tile_of(gx), grid.tile_of(gy)
    keyed = pixels.select(
        "zoom", tile_geohash(zoom, tx, ty).alias("geohash"),
        tx.alias("tile_x"), ty.alias("tile_y"),
        grid.local_of(gx).alias("x"), grid.local_of(gy).alias("y"), measure,
    )
    if ranged:
        return keyed.repartitionByRange(*(["zoom", "geohash"] if ranged is True else ranged))
    return keyed.repartition("zoom", "geohash")


def fill_words(parts: DataFrame, keys: Sequence[str], words: int, name: str) -> DataFrame:
    """Concatenate 64-bit words 0..words-1 per key, zero where a word is missing.

    ``parts``: keys, ``at``, the index of a word, and ``part``, the word with
    some of its bits set. Runs of four words are first combined by a primitive
    aggregate, so that the list per key has a quarter as many entries.
    """
    lanes = [f"_w{k}" for k in range(_RUN)]
    lane = F.col("at").bitwiseAND(F.lit(_RUN - 1))
    runs = parts.groupBy(*keys, F.shiftright("at", 2).alias("run")).agg(
        *[F.bit_or(F.when(lane == k, F.col("part"))).alias(w) for k, w in enumerate(lanes)])
    cells = runs.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("run", *lanes))).alias("cells"))
    zeros = lambda n: F.repeat(F.lit("0" * 16 * _RUN), n)
    digits = lambda word: F.lpad(F.hex(F.coalesce(word, F.lit(0))), 16, "0")

    def piece(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get("cells", i - 1)["run"], F.lit(-1))
        return F.concat(zeros(cell["run"] - before - 1), *[digits(cell[w]) for w in lanes])

    text = F.concat(
        F.array_join(F.transform("cells", piece), ""),
        zeros(F.lit(words // _RUN - 1) - F.element_at("cells", -1)["run"]),
    )
    return cells.select(*keys, F.unhex(text).alias(name))


def _byte_swapped(alt: Column) -> Column:
    """The stored 16-bit word of an altitude, low byte first, as a number."""
    word = F.pmod(alt + F.lit(ALTITUDE_SHIFT), F.lit(65536))
    low_first = F.shiftleft(word.bitwiseAND(F.lit(255)), 8) + F.shiftright(word, 8)
    return low_first.cast("bigint")


def into_word(value: Column, place: Column, width: int) -> Column:
    """Shift a ``width``-bit value to its place (0 first) in a 64-bit word."""
    return F.call_function("shiftleft", value, F.lit(64 - width) - place * width)


def pack_tiles(pixels: DataFrame, ranged: bool | Sequence[str] = False) -> DataFrame:
    """Pixels (zoom, gx, gy, alt) to tiles (zoom, geohash, tile_x, tile_y, tile).

    Four vertical neighbours share one 64-bit word and four words one entry, so
    the list built per tile has at most 4,096 entries.
    """
    pos = F.col("x") * TILE_SIDE + F.col("y")
    words = tile_pixels(pixels, ranged).select(
        *_KEYS,
        F.shiftright(pos, 2).alias("at"),
        into_word(_byte_swapped(F.col("alt")), F.col("y").bitwiseAND(F.lit(3)), 16).alias("part"),
    )
    return fill_words(words, _KEYS, TILE_PIXELS // 4, "tile")


def pixel_colour(pixels: DataFrame, palette: str | Sequence[ramps.Stop] = "gps") -> DataFrame:
    """Add 8-bit red, green, blue and an opaque alpha by altitude."""
    rgb = ramps.colour(ramps.altitude_share(F.col("alt")), palette)
    coloured = pixels.withColumn("_rgb", rgb)
    return coloured.select(
        *pixels.columns,
        *[ramps.to_byte(F.col("_rgb")[c]).alias(n)
          for c, n in (("r", "red"), ("g", "green"), ("b", "blue"))],
        F.lit(255).alias("alpha"),
    )


def tile_rgba(pixels: DataFrame, palette: str | Sequence[ramps.Stop] = "gps") -> DataFrame:
    """Tiles as RGBA rasters, row-major from the north-west; no data is transparent."""
    placed = tile_pixels(pixels, False)
    at = (F.lit(TILE_SIDE - 1) - F.col("y")) * TILE_SIDE + F.col("x")
    byte = lambda c, bits: F.shiftleft(F.col(c).cast("bigint"), bits)
    word = byte("red", 24) + byte("green", 16) + byte("blue", 8) + F.col("alpha").cast("bigint")
    words = pixel_colour(placed, palette).select(
        *_KEYS,
        F.shiftright(at, 1).alias("at"),
        into_word(word, at.bitwiseAND(F.lit(1)), 32).alias("part"),
    )
    return fill_words(words, _KEYS, TILE_PIXELS // 2, "raster")


def unpack_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles back to pixels (zoom, tile_x, tile_y, x, y, alt), no data left out.

    Tiles are cut into their 256 columns of 512 bytes before they reach Python,
    so Arrow batches stay at a few megabytes; empty columns stay behind.
    """
    column_bytes = 2 * TILE_SIDE
    cut = tiles.select(
        "zoom", "tile_x", "tile_y", "tile",
        F.explode(F.sequence(F.lit(0), F.lit(TILE_SIDE - 1))).alias("x"),
    ).select(
        "zoom", "tile_x", "tile_y", "x",
        F.substring("tile", F.col("x") * column_bytes + 1, F.lit(column_bytes)).alias("column"),
    ).where(F.col("column") != F.lit(bytes(column_bytes)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("column").to_pylist())
            words = np.frombuffer(raw, dtype="<u2").reshape(-1, TILE_SIDE)
            row, y = np.nonzero(words)
            alt = words[row, y].astype(np.int32) - ALTITUDE_SHIFT
            keys = [batch.column(c).take(pa.array(row)) for c in ("zoom", "tile_x", "tile_y", "x")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(y.astype(np.int32)), pa.array(alt)],
                names=["zoom", "tile_x", "tile_y", "x", "y", "alt"])

    schema = "zoom int, tile_x int, tile_y int, x int, y int, alt int"
    return cut.mapInArrow(decode, schema)


def tile_summary(pixels: DataFrame) -> DataFrame:
    """One row per tile without its raster: key, pixels set, altitude range."""
    zoom = F.col("zoom")
    tx, ty = grid.tile_of(F.col("gx")), grid.tile_of(F.col("gy"))
    tiles = pixels.groupBy("zoom", tx.alias("tile_x"), ty.alias("tile_y")).agg(
        F.count(F.lit(1)).alias("n_pixels"),
        F.min("alt").alias("min_alt"), F.max("alt").alias("max_alt"))
    key = tile_geohash(zoom, F.col("tile_x"), F.col("tile_y"))
    return tiles.select("zoom", key.alias("geohash"), "tile_x", "tile_y",
                        "n_pixels", "min_alt", "max_alt")


def pyramid_size(tiles: DataFrame) -> DataFrame:
    """Per zoom: stored tiles and bytes, next to those of a full map."""
    zoom = F.col("zoom")
    full = grid.grid_rows(zoom).cast("bigint") * grid.grid_cols(zoom).cast("bigint")
    found = tiles.groupBy("zoom").agg(
        F.count(F.lit(1)).alias("n_tiles"),
        F.sum(F.length("tile").cast("bigint")).alias("n_bytes"))
    return found.select(
        "zoom", "n_tiles", "n_bytes",
        full.alias("full_tiles"), (full * F.lit(TILE_BYTES)).alias("full_bytes"))


def tiles_sorted(tiles: DataFrame) -> DataFrame:
    """Total order of the tile table."""
    return tiles.orderBy("zoom", "geohash")
