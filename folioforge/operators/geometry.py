"""Spread detection, page boxes and crop geometry as column expressions over pages.

Pages have doc, page_idx and the rectangle x0, y0, x1, y1 in points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.config import DEFAULTS, Settings


def aspect(width: Column, height: Column) -> Column:
    return F.when(height > 0, width / height).otherwise(F.lit(0.0))


def is_spread(width: Column, height: Column, settings: Settings = DEFAULTS) -> Column:
    return aspect(width, height) >= F.lit(settings.spread_ratio)


def page_boxes(pages: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One box per page, or its left and right half if it is a spread; half is 0 or 1, bx0..by1 the box."""
    x0, y0, x1, y1 = map(F.col, ("x0", "y0", "x1", "y1"))
    middle = x0 + (x1 - x0) / 2
    box = lambda half, a, b: F.struct(F.lit(half).alias("half"), a.alias("bx0"), y0.alias("by0"), b.alias("bx1"), y1.alias("by1"))
    halves = F.when(is_spread(x1 - x0, y1 - y0, settings), F.array(box(0, x0, middle), box(1, middle, x1))).otherwise(F.array(box(0, x0, x1)))
    return pages.withColumn("_b", F.explode(halves)).select(*pages.columns, "_b.*")


def numbered(boxes: DataFrame, order: str = "page_idx") -> DataFrame:
    """box_idx: place of a box in its document, by page and half, from 0. A document's boxes meet in one task."""
    return boxes.withColumn("box_idx", F.row_number().over(Window.partitionBy("doc").orderBy(order, "half")) - 1)


def full_page(settings: Settings = DEFAULTS) -> Column:
    """Whether the box is the whole page, edge by edge."""
    return F.array_min(F.array(*[F.abs(F.col(b) - F.col(p)) < settings.edge_slack for b, p in (("bx0", "x0"), ("by0", "y0"), ("bx1", "x1"), ("by1", "y1"))]))


def crop_pixels(boxes: DataFrame, width: str = "img_width", height: str = "img_height") -> DataFrame:
    """The box in the image's pixels, cut down to whole ones: crop_x, crop_y, crop_w, crop_h and crop_spec."""
    sx, sy = F.col(width) / (F.col("x1") - F.col("x0")), F.col(height) / (F.col("y1") - F.col("y0"))
    at = lambda b, p, s: ((F.col(b) - F.col(p)) * s).cast("int")
    out = boxes.withColumns({"crop_x": at("bx0", "x0", sx), "crop_y": at("by0", "y0", sy), "_r": at("bx1", "x0", sx), "_d": at("by1", "y0", sy)})
    out = out.withColumns({"crop_w": F.col("_r") - F.col("crop_x"), "crop_h": F.col("_d") - F.col("crop_y")}).drop("_r", "_d")
    return out.withColumn("crop_spec", F.format_string("%dx%d+%d+%d", "crop_w", "crop_h", "crop_x", "crop_y"))


def crop_or_blank(crops: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """blank where a crop is too small to be an image, and the size that is written then."""
    w, h, least = F.col("crop_w"), F.col("crop_h"), settings.least_crop
    blank = (w < least) | (h < least)
    return crops.withColumns({"blank": blank, "out_w": F.when(blank, F.greatest(w, F.lit(least))).otherwise(w), "out_h": F.when(blank, F.greatest(h, F.lit(least))).otherwise(h)})
