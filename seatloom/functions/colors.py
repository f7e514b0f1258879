"""Colour expressions: gradients, the contrast curve, palettes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Palettes by name, from the low to the high end.
PALETTES = {
    "yellow_blue": ("#FFF7BC", "#003F87"),
    "blue_yellow": ("#003F87", "#FFF7BC"),
    "green_red": ("#4CAF50", "#B71C1C"),
    "red_green": ("#B71C1C", "#4CAF50"),
    "orange_purple": ("#FDB863", "#5E3C99"),
    "purple_orange": ("#5E3C99", "#FDB863"),
    "gray_red": ("#E0E0E0", "#B71C1C"),
    "red_gray": ("#B71C1C", "#E0E0E0"),
    "red_blue": ("#B71C1C", "#003F87"),
    "blue_red": ("#003F87", "#B71C1C"),
}
# Gradient of a bloc without one; fill of a seat without data; steepness and middle of the contrast curve.
DEFAULT_GRADIENT = ("#f0f9e8", "#0868ac")
NO_DATA = "#000000"
STEEPNESS, MIDDLE = 18, 0.5


def _channel(color: Column, i: int) -> Column:
    return F.conv(F.substring(F.replace(color, F.lit("#"), F.lit("")), 2 * i + 1, 2), 16, 10).cast("int")


def _clamped(t: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def _between(start: Column, end: Column, t: Column, whole, form: str) -> Column:
    t = _clamped(t)
    return F.format_string(form, *[whole(_channel(start, i) + (_channel(end, i) - _channel(start, i)) * t).cast("int") for i in range(3)])


def gradient(start: Column, end: Column, t: Column) -> Column:
    """Linear between two colours, channels cut to whole numbers, upper case."""
    return _between(start, end, t, lambda x: x, "#%02X%02X%02X")


def gradient_rounded(start: Column, end: Column, t: Column) -> Column:
    """Linear between two colours, channels rounded half up, lower case."""
    return _between(start, end, t, lambda x: F.floor(x + 0.5), "#%02x%02x%02x")


def contrast(ratio: Column) -> Column:
    """A logistic curve through (0, 0), (0.5, 0.5) and (1, 1), to 12 decimals so that engines agree."""
    low, high = (1 / (1 + math.exp(-STEEPNESS * (x - MIDDLE))) for x in (0.0, 1.0))
    curve = 1 / (1 + F.exp(-STEEPNESS * (_clamped(ratio) - MIDDLE)))
    return F.round((curve - low) / (high - low), 12)


def palettes() -> list[tuple[str, str | None, str | None]]:
    """(palette, low, high); for 'default' they are None and each bloc's own gradient stands in."""
    return [("default", None, None), *[(n, a, b) for n, (a, b) in PALETTES.items()]]
