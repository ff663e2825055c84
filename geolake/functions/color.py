"""Elevation colouring as Column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour stops (position 0..1, red, green, blue) of the named maps.
COLOR_MAPS = {
    "terrain": [
        (0, 0, 97, 71), (0.15, 34, 139, 34), (0.3, 154, 205, 50), (0.45, 255, 255, 102),
        (0.6, 255, 193, 37), (0.75, 205, 133, 63), (0.9, 139, 90, 43), (1, 255, 250, 250),
    ],
    "viridis": [
        (0, 68, 1, 84), (0.25, 59, 82, 139), (0.5, 33, 145, 140), (0.75, 94, 201, 98),
        (1, 253, 231, 37),
    ],
    "plasma": [
        (0, 13, 8, 135), (0.25, 126, 3, 168), (0.5, 204, 71, 120), (0.75, 248, 149, 64),
        (1, 240, 249, 33),
    ],
    "grayscale": [(0, 0, 0, 0), (1, 255, 255, 255)],
    "rainbow": [
        (0, 150, 0, 90), (0.125, 0, 0, 200), (0.25, 0, 25, 255), (0.375, 0, 152, 255),
        (0.5, 44, 255, 150), (0.625, 151, 255, 0), (0.75, 255, 234, 0), (0.875, 255, 111, 0),
        (1, 255, 0, 0),
    ],
    "elevation": [
        (0, 0, 0, 255), (0.25, 0, 255, 255), (0.5, 0, 255, 0), (0.75, 255, 255, 0),
        (1, 255, 0, 0),
    ],
    "shade": [(0, 76.5, 76.5, 76.5), (1, 255, 255, 255)],
}
# Absolute elevation (metres) to colour, for relief maps.
RELIEF_STOPS = [
    (2486, 34, 139, 34), (2600, 144, 238, 144), (2800, 255, 255, 0), (3000, 255, 165, 0),
    (3200, 255, 69, 0), (3400, 220, 20, 60), (3600, 139, 0, 0), (3757, 255, 255, 255),
]


def _channel(t: Column, stops: Sequence[tuple], channel: int) -> Column:
    value = F.lit(float(stops[-1][channel]))
    for low, high in reversed(list(zip(stops, stops[1:]))):
        start, rise, width = float(low[channel]), high[channel] - low[channel], high[0] - low[0]
        value = F.when(t <= high[0], start + (t - low[0]) / width * rise).otherwise(value)
    return F.floor(value + 0.5).cast("int")


def _ramp(t: Column, stops: Sequence[tuple], present: Column) -> Column:
    parts = [
        F.when(present, _channel(t, stops, i)).otherwise(F.lit(0)).alias(name)
        for i, name in ((1, "r"), (2, "g"), (3, "b"))
    ]
    return F.struct(*parts, F.when(present, 255).otherwise(F.lit(0)).alias("a"))


def color_ramp(value: Column, low: Column, high: Column, stops: str | Sequence[tuple] = "terrain") -> Column:
    """Value scaled by [low, high] -> r, g, b, a bytes; nodata is fully transparent."""
    chosen = COLOR_MAPS[stops] if isinstance(stops, str) else stops
    t = F.least(F.greatest(F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return _ramp(t, chosen, value.isNotNull() & ~F.isnan(value))


def relief_color(value: Column, stops: Sequence[tuple] = RELIEF_STOPS) -> Column:
    """Absolute-elevation ramp; values outside the stops take the nearest end colour."""
    t = F.least(F.greatest(value, F.lit(float(stops[0][0]))), F.lit(float(stops[-1][0])))
    return _ramp(t, stops, value.isNotNull() & ~F.isnan(value))


def blend(band: Column, shade: Column) -> Column:
    """Darken a colour byte by a hillshade byte."""
    return F.least(F.greatest(band * (0.3 + shade / 255.0 * 0.7), F.lit(0.0)), F.lit(255.0)).cast("int")
