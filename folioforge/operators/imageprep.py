"""Resolution and skew arithmetic before recognition, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.config import DEFAULTS, Settings

POINTS = 72


def page_dpi(img_width: Column, img_height: Column, width: Column, height: Column) -> Column:
    """Mean of the two resolutions of an image that fills a page; null for a page without extent."""
    return (F.try_divide(img_width, width / POINTS) + F.try_divide(img_height, height / POINTS)) / 2


def new_dpi(dpi: Column, ratio: Column) -> Column:
    return (dpi * ratio).cast("int")


def page_points(pixels: Column, dpi: Column) -> Column:
    """Page extent of that many pixels; null at 0 DPI."""
    return F.try_divide(pixels * POINTS, dpi.cast("double"))


def upscaled(pixels: Column, ratio: Column) -> Column:
    return (pixels * ratio).cast("int")


def applied_skew(angle: Column, settings: Settings = DEFAULTS) -> Column:
    """The angle to rotate by: 0 where it is unknown, not a number, implausibly large or negligible."""
    size = F.abs(angle)
    return F.when(~F.isnan(angle) & (size <= settings.skew_limit) & (size > settings.skew_ignored), angle).otherwise(F.lit(0.0))


def needs_transform(angle: Column, ratio: Column, settings: Settings = DEFAULTS) -> Column:
    return (F.abs(angle) > settings.skew_ignored) | (F.abs(ratio - 1) > 0.01)
