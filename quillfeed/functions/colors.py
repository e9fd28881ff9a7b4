"""Colour expressions (PRJ34 fade, hex formatting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillfeed import config


def _channel(hex_col: Column, pos: int) -> Column:
    return F.conv(F.substring(hex_col, pos, 2), 16, 10).cast("int")


def _hex2(c: Column, upper: bool) -> Column:
    h = F.lpad(F.hex(c.cast("long")), 2, "0")
    return h if upper else F.lower(h)


def fade_to_brighter(hex_col: Column, factor: float = config.COLOR_FADE) -> Column:
    """PRJ34: blend ``#rrggbb`` toward white by ``factor``, truncate, clamp, upper-case hex."""
    parts = []
    for pos in (2, 4, 6):
        c = _channel(hex_col, pos)
        faded = F.floor(c + F.lit(factor) * (F.lit(255) - c))
        parts.append(_hex2(F.least(F.lit(255), F.greatest(F.lit(0), faded)), upper=True))
    return F.concat(F.lit("#"), *parts)


def rgb_hex(r: Column, g: Column, b: Column) -> Column:
    """``#rrggbb`` lower-case, as the edge-colour helper writes it."""
    return F.concat(F.lit("#"), _hex2(r, False), _hex2(g, False), _hex2(b, False))

