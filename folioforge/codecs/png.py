"""PNG images of 8-bit gray, RGB or either with alpha, in numpy and zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# The signature, and channels of each colour type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(pixels: np.ndarray, dpi: float | None = None) -> bytes:
    """pixels: height x width, or height x width x channels, unsigned 8-bit."""
    if pixels.ndim == 2:
        pixels = pixels[:, :, None]
    height, width, channels = pixels.shape
    kind = {n: k for k, n in CHANNELS.items()}[channels]
    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    rows = np.zeros((height, 1 + width * channels), np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)
    density = b""
    if dpi:
        per_metre = round(dpi / 0.0254)
        density = _chunk(b"pHYs", struct.pack(">IIB", per_metre, per_metre, 1))
    return SIGNATURE + _chunk(b"IHDR", head) + density + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def chunks(data: bytes):
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG image")
    at = 8
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        yield kind, data[at + 8 : at + 8 + n]
        at += 12 + n


def size(data: bytes) -> tuple[int, int]:
    for kind, body in chunks(data):
        if kind == b"IHDR":
            return struct.unpack(">II", body[:8])
    raise ValueError("a PNG image without a header")


def dpi(data: bytes) -> float | None:
    for kind, body in chunks(data):
        if kind == b"pHYs" and body[8] == 1:
            return struct.unpack(">I", body[:4])[0] * 0.0254
    return None


def decode(data: bytes) -> np.ndarray:
    """height x width (gray) or height x width x channels. ValueError for other depths, palettes and interlacing."""
    head, parts = None, []
    for kind, body in chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("an unsupported kind of PNG image")
    width, height, channels = head[0], head[1], CHANNELS[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * channels)
    return unfilter(raw[:, 0], raw[:, 1:], channels).reshape((height, width) if channels == 1 else (height, width, channels))


def unfilter(kinds: np.ndarray, rows: np.ndarray, step: int) -> np.ndarray:
    """Scan lines restored from their differences to the left (1), above (2), their mean (3) or Paeth's choice (4)."""
    out = np.zeros(rows.shape, np.uint8)
    above = np.zeros(rows.shape[1], np.uint8)
    for y, kind in enumerate(kinds):
        row = rows[y]
        if kind == 0:
            out[y] = row
        elif kind == 2:
            out[y] = row + above
        elif kind == 1:
            out[y] = np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        elif kind in (3, 4):
            own = row.tolist()
            up = above.tolist()
            for x in range(len(own)):
                left = own[x - step] if x >= step else 0
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    corner = up[x - step] if x >= step else 0
                    base = left + up[x] - corner
                    guess = min((left, up[x], corner), key=lambda v, b=base: abs(b - v))
                own[x] = (own[x] + guess) & 255
            out[y] = own
        else:
            raise ValueError("an unknown PNG filter")
        above = out[y]
    return out


def blank(width: int, height: int) -> bytes:
    """A white RGB image."""
    return encode(np.full((height, width, 3), 255, np.uint8))
