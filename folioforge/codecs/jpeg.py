"""JPEG headers, as a scalar function and as an Arrow column function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers C0-CF open a frame, but for C4 (tables), C8 (extension) and CC (conditioning); markers
# without a body.
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
BARE = frozenset({0x01, *range(0xD0, 0xD9)})


def dimensions(data: bytes) -> tuple[int, int]:
    """(width, height) of the first frame. ValueError if it isn't a JPEG image or has none."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG image")
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in BARE:
            at += 2
        elif marker in FRAMES and at + 9 <= len(data):
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    raise ValueError("a JPEG image without a frame")


def components(data: bytes) -> int:
    """Colour components of the first frame; 3 if there is none."""
    at = 2
    while at + 10 <= len(data):
        marker = data[at + 1]
        if data[at] != 0xFF or marker == 0xFF:
            at += 1
        elif marker in BARE:
            at += 2
        elif marker in FRAMES:
            return data[at + 9]
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return 3


def dimensions_column(data: Column) -> Column:
    """struct width, height, error of a binary column; null data has an error."""

    @F.pandas_udf("width int, height int, error string")
    def read(values: pd.Series) -> pd.DataFrame:
        out = []
        for v in values:
            try:
                out.append((*dimensions(bytes(v or b"")), None))
            except ValueError as e:
                out.append((None, None, str(e)))
        frame = pd.DataFrame(out, columns=["width", "height", "error"])
        return frame.astype({"width": "Int32", "height": "Int32"})

    return read(data)
