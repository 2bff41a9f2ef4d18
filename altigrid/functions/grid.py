"""Integer grid indices of the zoom pyramid.

Zoom ``z`` has ``2**z`` rows by ``2**(z+1)`` columns of square tiles, each
``180 / 2**z`` degrees wide and 256 x 256 pixels. Pixels are numbered over the
whole map (``gx`` to the east, ``gy`` to the north), so that the tile of a
pixel is ``g >> 8``, its place in the tile ``g & 255`` and its parent one zoom
up ``g >> 1``. Multiplying before dividing keeps that last identity exact for
every double (scaling by a power of two never rounds).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TILE_SIDE = 256
TILE_BITS = 8
MAX_ZOOM = 10
BAND_BITS = 11
# Tile keys tell tiles apart up to zoom 19; INT indices would hold one zoom more.
ZOOM_LIMIT = 19

LAT_MIN, LAT_MAX = -90.0, 90.0
LON_MIN, LON_MAX = -180.0, 180.0


def _power(base: int, zoom: int | Column) -> Column:
    """``base * 2**zoom`` as an integer column; ``zoom`` may vary by row."""
    if isinstance(zoom, Column):
        return F.call_function("shiftleft", F.lit(base), zoom)
    return F.lit(base << zoom)


def _axis_index(deg: Column, origin: float, cells_per_180: Column, last: Column) -> Column:
    # The largest double below 180 makes deg - origin round up to a full turn.
    raw = F.floor((deg - F.lit(origin)) * cells_per_180.cast("double") / F.lit(180.0))
    return F.least(raw, last.cast("bigint")).cast("int")


def grid_index(lat: Column, lon: Column, zoom: int | Column, side: int) -> tuple[Column, Column]:
    """Column and row of the cell that holds a point, ``side`` cells per tile edge.

    Points must already be inside the map bounds.
    """
    per_180 = _power(side, zoom)
    gx = _axis_index(lon, LON_MIN, per_180, _power(2 * side, zoom) - 1)
    gy = _axis_index(lat, LAT_MIN, per_180, per_180 - 1)
    return gx, gy


def pixel_index(lat: Column, lon: Column, zoom: int | Column) -> tuple[Column, Column]:
    """Map-wide pixel column and row of a point."""
    return grid_index(lat, lon, zoom, TILE_SIDE)


def tile_index(lat: Column, lon: Column, zoom: int | Column) -> tuple[Column, Column]:
    """Tile column and row of a point (also the cell of one angular step)."""
    return grid_index(lat, lon, zoom, 1)


def tile_of(g: Column) -> Column:
    return F.shiftright(g, TILE_BITS)


def local_of(g: Column) -> Column:
    return g.bitwiseAND(F.lit(TILE_SIDE - 1))


# The bits of 0..1023, each moved to twice its place.
_SPREAD = " ".join(str(sum((v >> k & 1) << 2 * k for k in range(10))) for v in range(1024))


def _spread(v: Column) -> Column:
    table = F.split(F.lit(_SPREAD), " ").cast("array<bigint>")  # folds to one constant array
    half = lambda bits: F.get(table, bits.bitwiseAND(F.lit(1023)))
    return half(v) + F.shiftleft(half(F.shiftright(v, 10)), 20)


def tile_code(tile_x: Column, tile_y: Column) -> Column:
    """Interleaved bits of a tile's indices, the lowest one of tile_x.

    Within a zoom it orders tiles as their geohash does, ``code >> 2`` is the
    parent's code, and all tiles below one ancestor are an interval.
    """
    return _spread(tile_x) + F.shiftleft(_spread(tile_y), 1)


def band_of(code: Column) -> Column:
    """Number of the interval of 2,048 codes that holds a code."""
    return F.shiftright(code, BAND_BITS).cast("int")


def step_degrees(zoom: int | Column) -> Column:
    return F.lit(180.0) / _power(1, zoom).cast("double")


def tile_lat(tile_y: Column, zoom: int | Column) -> Column:
    """Southern edge of a tile row."""
    return tile_y.cast("double") * step_degrees(zoom) + F.lit(LAT_MIN)


def tile_lon(tile_x: Column, zoom: int | Column) -> Column:
    """Western edge of a tile column."""
    return tile_x.cast("double") * step_degrees(zoom) + F.lit(LON_MIN)


def snap_to_step(lat: Column, lon: Column, zoom: int | Column) -> tuple[Column, Column]:
    """Corner of the angular-step cell that holds a point: (lat, lon)."""
    tx, ty = tile_index(lat, lon, zoom)
    return tile_lat(ty, zoom), tile_lon(tx, zoom)


def grid_rows(zoom: int | Column) -> Column:
    return _power(1, zoom)


def grid_cols(zoom: int | Column) -> Column:
    return _power(2, zoom)


def clamp(value: Column, low, high) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(value, as_col(low)), as_col(high))


def tile_key_text(zoom: Column, tile_x: Column, tile_y: Column, x: Column, y: Column) -> Column:
    """Export name ``lat#lon#zoom#x#y`` of a pixel; never used for grouping."""
    parts = (tile_lat(tile_y, zoom), tile_lon(tile_x, zoom), zoom, x, y)
    return F.concat_ws("#", *[p.cast("string") for p in parts])


def split_tile_key(key: Column) -> list[Column]:
    """Inverse of :func:`tile_key_text`: tile_lat, tile_lon, zoom, x, y."""
    part = F.split(key, "#")
    types = ("double", "double", "int", "int", "int")
    return [F.get(part, F.lit(i)).cast(t) for i, t in enumerate(types)]
