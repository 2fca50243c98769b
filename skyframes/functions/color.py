"""Pixel colour expressions. A pixel is one INT holding B, G and R, 8 bits each from the top."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blue(bgr: Column) -> Column:
    return F.shiftright(bgr, 16).bitwiseAND(255)


def green(bgr: Column) -> Column:
    return F.shiftright(bgr, 8).bitwiseAND(255)


def red(bgr: Column) -> Column:
    return bgr.bitwiseAND(255)


def pack_bgr(b: Column, g: Column, r: Column) -> Column:
    return b * 65536 + g * 256 + r


def is_sky_color(b: Column, g: Column, r: Column) -> Column:
    """Colour rule for sky: deep blue, bright, saturated blue, or dark blue pixels."""
    # fixed values of the rule: brightness limits 100 and 120, channel gap 20
    green_over_red = (g - r) > 20
    deep_blue = (b > 120) & (g > 100) & (r < 100) & green_over_red
    bright = (b > 100) & (g > 100) & (r > 100)
    saturated = (b > 100) & (g < 100) & (r < 100) & green_over_red
    dark = (b < 100) & (g < 100) & (r < 100) & ((b - g) > 20) & green_over_red
    return deep_blue | bright | saturated | dark


def luma(b: Column, g: Column, r: Column) -> Column:
    """Rounded grey value 0..255."""
    # fixed values: per mille weights of R, G and B
    return F.floor((r * 299 + g * 587 + b * 114 + 500) / 1000).cast("int")


def hue(b: Column, g: Column, r: Column) -> Column:
    """Hexcone hue in half degrees 0..179; grey pixels have hue 0."""
    top = F.greatest(b, g, r)
    span = (top - F.least(b, g, r)).cast("double")
    degrees = (
        F.when(span == 0, F.lit(0.0))
        .when(top == r, F.pmod(F.try_divide((g - b) * 60.0, span), F.lit(360.0)))
        .when(top == g, F.try_divide((b - r) * 60.0, span) + 120.0)
        .otherwise(F.try_divide((r - g) * 60.0, span) + 240.0)
    )
    return (F.floor(degrees / 2 + 0.5) % 180).cast("int")


def is_sun_hue(b: Column, g: Column, r: Column, limit: int = 10) -> Column:
    """Overexposed and reddish pixels: hue at most `limit`.

    Same as ``hue(b, g, r) <= limit`` but without the divisions: only the red sextant,
    from -1 to ``2 * limit + 1`` degrees, rounds to a half-degree hue in that range.
    """
    span = F.greatest(b, g, r) - F.least(b, g, r)
    lead = (g - b) * 60
    return (span == 0) | ((F.greatest(b, g, r) == r) & (lead >= -span) & (lead < span * (2 * limit + 1)))
