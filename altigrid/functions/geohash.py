"""Geohash keys as plain column arithmetic (no UDF).

A geohash is a number in base 32 whose bits alternate between the axes, the
first one longitude. Two characters hold five bits of each axis, so a pair of
characters is one look-up in a table of 1,024 pairs at ``lon * 32 + lat``: the
interleaved number itself is never built.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The public base-32 alphabet of geohash, and the digits that
# number conversion uses in the same base.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

TILE_KEY_LENGTH = 8
CITY_KEY_LENGTH = 10
POINT_KEY_LENGTH = 6
MAX_LENGTH = 12


def _weave(lon: int, lat: int) -> int:
    return sum((lon >> k & 1) << 2 * k + 1 | (lat >> k & 1) << 2 * k for k in range(5))


# Interleaved value of each (lon, lat), in the order lon * 32 + lat.
_WOVEN = [_weave(lon, lat) for lon in range(32) for lat in range(32)]
_PAIRS = " ".join(ALPHABET[code >> 5] + ALPHABET[code & 31] for code in _WOVEN)
_UNPAIRS = " ".join(str(at) for at in sorted(range(1024), key=_WOVEN.__getitem__))


def _axis_bits(length: int) -> tuple[int, int]:
    """Number of longitude and latitude bits."""
    bits = 5 * length
    return bits - bits // 2, bits // 2


def geohash_of_bits(lon_bits: Column, lat_bits: Column, length: int, inside: Column | None = None) -> Column:
    """Key of even length from the axis integers of ``5 * length / 2`` bits each.

    Null unless ``inside``: a condition around the first pair of characters alone, as one
    around the whole key doubles the generated code.
    """
    pairs = F.split(F.lit(_PAIRS), " ")  # folds to one constant array
    out = []
    for left in range(5 * (length // 2 - 1), -1, -5):
        lon = F.shiftright(lon_bits, left).bitwiseAND(F.lit(31))
        lat = F.shiftright(lat_bits, left).bitwiseAND(F.lit(31))
        out.append(F.get(pairs, (F.shiftleft(lon, 5) + lat).cast("int")))
    if inside is not None:
        out[0] = F.when(inside, out[0])
    return F.concat(*out)


def geohash(lat: Column, lon: Column, length: int) -> Column:
    """Geohash of a coordinate, 1 to 12 characters; null off the map.

    The north and east edges belong to the last cell.
    """
    if not 1 <= length <= MAX_LENGTH:
        raise ValueError(f"geohash length must be 1..{MAX_LENGTH}")
    if length % 2:
        # A shorter key is a prefix of the longer one.
        return F.substring(geohash(lat, lon, length + 1), 1, length)
    cells = 2 ** (5 * length // 2)

    def axis(deg: Column, origin: float, turn: float) -> Column:
        at = F.floor((deg + F.lit(origin)) * F.lit(float(cells)) / F.lit(turn))
        return F.least(at, F.lit(cells - 1).cast("bigint"))

    inside = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return geohash_of_bits(axis(lon, 180.0, 360.0), axis(lat, 90.0, 180.0), length, inside)


def tile_geohash(zoom: Column, tile_x: Column, tile_y: Column) -> Column:
    """8-character key of a tile's south-west corner, from its indices alone.

    The corner is a cell edge of the 20 + 20 bit grid up to zoom 19, so the key
    is unique within a zoom; the same corner recurs over zooms, hence the full
    key of a tile is ``(zoom, geohash)``.
    """
    shift = lambda v, by: F.call_function("shiftleft", v.cast("bigint"), by)
    key = geohash_of_bits(shift(tile_x, 19 - zoom), shift(tile_y, 20 - zoom), TILE_KEY_LENGTH)
    return F.when(zoom.between(0, 19), key).otherwise(F.raise_error(F.lit("tile keys need a zoom of 0 to 19")))


def geohash_decode(key: Column, length: int) -> tuple[Column, Column]:
    """Centre coordinate (lat, lon) of a key of known length."""
    nlon, nlat = _axis_bits(length)
    if length % 2:
        key = F.concat(key, F.lit("0"))
    pairs = (length + 1) // 2
    code = F.conv(F.translate(key, ALPHABET, DIGITS), 32, 10).cast("bigint")
    table = F.split(F.lit(_UNPAIRS), " ").cast("array<bigint>")  # folds as well
    lon_bits = lat_bits = F.lit(0).cast("bigint")
    for k in range(pairs):
        chunk = F.shiftright(code, 10 * k).bitwiseAND(F.lit(1023)).cast("int")
        axes = F.get(table, chunk)
        lon_bits = lon_bits + F.shiftleft(F.shiftright(axes, 5), 5 * k)
        lat_bits = lat_bits + F.shiftleft(axes.bitwiseAND(F.lit(31)), 5 * k)

    def centre(bits: Column, count: int, turn: float, origin: float) -> Column:
        cell = F.shiftright(bits, 5 * pairs - count).cast("double") + F.lit(0.5)
        return cell * F.lit(turn / 2**count) - F.lit(origin)

    return centre(lat_bits, nlat, 180.0, 90.0), centre(lon_bits, nlon, 360.0, 180.0)
