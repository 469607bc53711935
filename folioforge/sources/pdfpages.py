"""PDF files as one row per page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from folioforge.codecs import pdf

SCHEMA = (
    "doc string, page_idx long, x0 double, y0 double, x1 double, y1 double, rotation int, "
    "images array<struct<ext string, width int, height int, data binary>>, contents array<binary>, objects map<string, binary>, fonts array<string>, error string"
)


def pages_of(files: DataFrame, path: str = "path") -> DataFrame:
    """Pages of the files named in a column; a file that can't be read gives one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc", "page_idx", "x0", "y0", "x1", "y1", "rotation", "images", "contents", "objects", "fonts", "error"]
        for frame in frames:
            for doc in frame["doc"]:
                try:
                    with open(doc, "rb") as f:
                        own = pdf.read(f.read())
                    rows = [(doc, i, *map(float, p.rect), p.rotation, [(x.ext, x.width, x.height, x.data) for x in p.images], p.contents, p.objects, p.fonts, None) for i, p in enumerate(own)]
                except Exception as e:  # the file's result
                    rows = [(doc, None, None, None, None, None, None, None, None, None, None, str(e))]
                yield pd.DataFrame(rows, columns=names).astype({"page_idx": "Int64", "rotation": "Int32"})

    return files.selectExpr(f"{path} as doc").mapInPandas(run, SCHEMA)
