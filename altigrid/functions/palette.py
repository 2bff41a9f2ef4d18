"""Piecewise-linear colour ramps over a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

Stop = tuple[float, float, float, float]

# Fixed values: (position, red, green, blue) of the known ramps. The GPS ramp
# gives its positions in percent and its channels in 0..255; its double stop at
# 50 is the shore line.
RAINBOW: list[Stop] = [
    (0.0, 1.0, 0.0, 0.0),
    (0.25, 1.0, 1.0, 0.0),
    (0.5, 0.0, 1.0, 0.0),
    (0.75, 0.0, 1.0, 1.0),
    (1.0, 0.0, 0.0, 1.0),
]
HOTMAP: list[Stop] = [
    (0.0, 0.0, 0.0, 0.0),
    (0.333, 1.0, 0.0, 0.0),
    (0.667, 1.0, 1.0, 0.0),
    (1.0, 1.0, 1.0, 1.0),
]
GPS_PERCENT_255: list[Stop] = [
    (0.0, 0, 0, 0),
    (6.25, 0, 5, 25),
    (12.5, 0, 10, 50),
    (18.75, 0, 80, 125),
    (25.0, 0, 150, 200),
    (31.25, 86, 197, 184),
    (37.5, 172, 245, 168),
    (43.75, 211, 250, 211),
    (50.0, 250, 255, 255),
    (50.0, 70, 120, 50),
    (53.12, 120, 100, 50),
    (56.25, 146, 126, 60),
    (62.5, 198, 178, 80),
    (68.75, 250, 230, 100),
    (75.0, 250, 234, 126),
    (81.25, 252, 238, 152),
    (87.5, 252, 243, 177),
    (93.75, 253, 249, 216),
    (100.0, 255, 255, 255),
]
GPS: list[Stop] = [(p / 100, r / 255, g / 255, b / 255) for p, r, g, b in GPS_PERCENT_255]

PALETTES: dict[str, list[Stop]] = {"rainbow": RAINBOW, "hotmap": HOTMAP, "gps": GPS}


def palette_from_object(definition: Mapping) -> list[Stop]:
    """Stops of ``{"name": .., "values": {position: [r, g, b]}}``, ordered as numbers."""
    stops = [(float(at), *(float(c) for c in rgb)) for at, rgb in definition["values"].items()]
    return sorted(stops, key=lambda s: s[0])


def palette_stops(palette: str | Sequence[Stop]) -> list[Stop]:
    """Stops of a known name; an unknown name has none (all black)."""
    if isinstance(palette, str):
        return PALETTES.get(palette, [])
    return sorted((tuple(s) for s in palette), key=lambda s: s[0])


def _constants(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def colour(value: Column, palette: str | Sequence[Stop]) -> Column:
    """Struct (r, g, b) in 0..1 at ``value``, held flat beyond both ends.

    A short chain of comparisons finds the stop to the right; the blend then
    reads constants at that place, so the code stays small for any ramp.
    """
    stops = palette_stops(palette)
    if not stops:
        return F.struct(*[F.lit(0.0).alias(c) for c in "rgb"])
    # Both ends repeat their stop: the colour is flat outside.
    right = [*stops, stops[-1]]
    left = [stops[0], *stops[:-1], stops[-1]]
    place = F.coalesce(*[F.when(value < F.lit(s[0]), k) for k, s in enumerate(stops)],
                       F.lit(len(stops)))
    at = lambda values: F.get(_constants(values), place)
    span = [a[0] - b[0] for a, b in zip(left, right)]
    share = (value - at([b[0] for b in right])) / at([d or 1.0 for d in span])

    def channel(c: int) -> Column:
        # A zero span has equal colours on both sides or is never reached.
        change = [a[c] - b[c] if d else 0.0 for a, b, d in zip(left, right, span)]
        return at(change) * share + at([b[c] for b in right])

    return F.struct(*[channel(c).alias(name) for c, name in ((1, "r"), (2, "g"), (3, "b"))])


def altitude_share(alt: Column) -> Column:
    """Altitude over -8000..8000 as 0..1: sea level is the shore stop."""
    return (alt.cast("double") + F.lit(8000.0)) / F.lit(16000.0)


def to_byte(channel: Column) -> Column:
    """0..1 to 0..255, to the nearest value (ties to even), as image data stores it."""
    return F.rint(channel * F.lit(255.0)).cast("int")
