"""Moving a recognised text layer onto source pages: stream gates, line filters, page and font merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What marks recognition objects and image drawing in content streams.
OBJECT, IMAGE, DRAW = "/OCR-", "/Im", "Do"


def decoded(data: Column) -> Column:
    """Bytes as text, one character per byte, and back by encoded()."""
    return F.decode(data, "ISO-8859-1")


def encoded(text: Column) -> Column:
    return F.encode(text, "ISO-8859-1")


def draws_object(stream: Column, mark: str = OBJECT, draw: str = DRAW) -> Column:
    return F.contains(stream, F.lit(mark)) & F.contains(stream, F.lit(draw))


def without_image_lines(text: Column, image: str = IMAGE, draw: str = DRAW) -> Column:
    """Lines that draw an image left out; lines end at line feeds alone."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~(F.contains(x, F.lit(image)) & F.contains(x, F.lit(draw)))), "\n")


def text_objects(objects: Column, mark: str = OBJECT) -> Column:
    """Of a page's map of named objects, those that hold recognised text."""
    return F.map_filter(objects, lambda k, v: F.startswith(k, F.lit(mark)) & v.isNotNull())


def page_text(streams: Column, objects: Column) -> Column:
    """Text for a page: its text objects' filtered contents in name order, once for each stream that draws one."""
    own = F.array_sort(F.map_entries(text_objects(objects)))
    parts = F.transform(own, lambda e: without_image_lines(e["value"]))
    drawing = F.filter(streams, lambda s: draws_object(s))
    return F.array_join(F.flatten(F.transform(drawing, lambda s: parts)), "\n")


def merge_pages(source: DataFrame, layer: DataFrame, doc: str = "doc", index: str = "page_idx", text: str = "text") -> DataFrame:
    """Source pages with the text of the layer's page of the same place, null beyond its last; its surplus is lost."""
    other = layer.select(doc, index, F.col(text).alias("layer_text"))
    return source.join(other, [doc, index], "left")


def appended(contents: Column, text: Column) -> Column:
    """Contents with the text after them; unchanged where it is empty or null."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.concat(contents, F.array(text))).otherwise(contents)


def page_count_mismatch(source: DataFrame, layer: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents whose two page counts differ: doc, source_pages, layer_pages, merged_pages."""
    a = source.groupBy(doc).agg(F.count("*").alias("source_pages"))
    b = layer.groupBy(doc).agg(F.count("*").alias("layer_pages"))
    both = a.join(b, doc, "full").na.fill(0, ["source_pages", "layer_pages"])
    return both.where("source_pages != layer_pages").withColumn("merged_pages", F.least("source_pages", "layer_pages"))


def merge_fonts(source: DataFrame, layer: DataFrame, page: str, order: str, font: str = "font", value: str = "value") -> DataFrame:
    """A page's own fonts, and those of the layer whose names it lacks; of several layer fonts of a name the last."""
    last = layer.groupBy(page, font).agg(F.max_by(value, order).alias(value)).join(source.select(page, font).distinct(), [page, font], "left_anti")
    return source.select(page, font, value, F.lit(False).alias("copied")).unionByName(last.withColumn("copied", F.lit(True)))


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key, value of each key's last row; a null of the last row stays null."""
    return rows.groupBy(key).agg(F.max_by(F.struct(value), order).alias("_v")).select(key, F.col(f"_v.{value}").alias(value))


def first_pages(rows: DataFrame, doc: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(doc).orderBy(order))).where("_n = 1").drop("_n")
