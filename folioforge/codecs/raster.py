"""Raster operations in numpy: crop, bicubic resize, rotation and skew estimation."""

from __future__ import annotations

import numpy as np


def gray(pixels: np.ndarray) -> np.ndarray:
    """Luma of RGB; other images' first channel."""
    if pixels.ndim == 2:
        return pixels
    if pixels.shape[2] < 3:
        return pixels[:, :, 0]
    return np.rint(pixels[:, :, :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def normalised(pixels: np.ndarray) -> np.ndarray:
    """Gray and RGB images as they are; alpha dropped."""
    if pixels.ndim == 3 and pixels.shape[2] in (2, 4):
        pixels = pixels[:, :, :-1]
    return pixels[:, :, 0] if pixels.ndim == 3 and pixels.shape[2] == 1 else pixels


def crop(pixels: np.ndarray, x: int, y: int, width: int, height: int) -> np.ndarray:
    """The part inside the image; what lies outside is black."""
    out = np.zeros((height, width, *pixels.shape[2:]), np.uint8)
    top, left = max(0, y), max(0, x)
    own = pixels[top : y + height, left : x + width]
    out[top - y : top - y + own.shape[0], left - x : left - x + own.shape[1]] = own
    return out


def _cubic(d: np.ndarray) -> np.ndarray:
    """Keys' kernel with a = -1/2."""
    d = np.abs(d)
    return np.where(d < 1, (1.5 * d - 2.5) * d * d + 1, np.where(d < 2, ((-0.5 * d + 2.5) * d - 4) * d + 2, 0))


def _weights(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of m outputs, the inputs that count and their weights; the kernel widens when shrinking."""
    scale = max(1.0, n / m)
    centre = (np.arange(m) + 0.5) * n / m - 0.5
    reach = int(np.ceil(2 * scale))
    index = np.floor(centre).astype(int)[:, None] + np.arange(-reach + 1, reach + 1)
    weight = _cubic((index - centre[:, None]) / scale) * ((index >= 0) & (index < n))
    return np.clip(index, 0, n - 1), weight / weight.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    own = pixels.astype(np.float64)
    index, weight = _weights(own.shape[0], height)
    own = np.einsum("mk,mk...->m...", weight, own[index])
    index, weight = _weights(own.shape[1], width)
    own = np.einsum("mk,amk...->am...", weight, own[:, index])
    return np.clip(np.rint(own), 0, 255).astype(np.uint8)


def rotate(pixels: np.ndarray, degrees: float) -> np.ndarray:
    """Turned counter-clockwise about its centre on a canvas that holds all of it, white around, bicubic."""
    a = np.deg2rad(degrees)
    height, width = pixels.shape[:2]
    new_w = int(np.ceil(abs(width * np.cos(a)) + abs(height * np.sin(a)) - 1e-9))
    new_h = int(np.ceil(abs(width * np.sin(a)) + abs(height * np.cos(a)) - 1e-9))
    y, x = np.mgrid[0:new_h, 0:new_w].astype(float)
    x, y = x - (new_w - 1) / 2, y - (new_h - 1) / 2
    from_x, from_y = x * np.cos(a) - y * np.sin(a) + (width - 1) / 2, x * np.sin(a) + y * np.cos(a) + (height - 1) / 2
    left, top = np.floor(from_x).astype(int), np.floor(from_y).astype(int)
    out, total = np.zeros((new_h, new_w, *pixels.shape[2:])), np.zeros((new_h, new_w))
    for dy in range(-1, 3):
        for dx in range(-1, 3):
            w = _cubic(from_x - (left + dx)) * _cubic(from_y - (top + dy))
            there = (left + dx >= 0) & (left + dx < width) & (top + dy >= 0) & (top + dy < height)
            value = np.where(there.reshape(*there.shape, *[1] * (pixels.ndim - 2)), pixels[np.clip(top + dy, 0, height - 1), np.clip(left + dx, 0, width - 1)], 255.0)
            out += value * w.reshape(*w.shape, *[1] * (pixels.ndim - 2))
            total += w
    return np.clip(np.rint(out / total.reshape(*total.shape, *[1] * (pixels.ndim - 2))), 0, 255).astype(np.uint8)


def skew(pixels: np.ndarray, limit: float = 15.0) -> float | None:
    """Counter-clockwise degrees that level the lines of dark marks; None if there are too few marks.

    Lines are level when the marks' row profile is sharpest; angles are tried from coarse to fine.
    """
    own = gray(pixels)
    step = max(1, max(own.shape) // 1000)
    y, x = np.nonzero(own[::step, ::step] < min(128, int(own.mean())))
    if len(y) < 50:
        return None

    def sharpness(degrees: float) -> float:
        t = np.deg2rad(degrees)
        rows = np.rint(y * np.cos(t) - x * np.sin(t)).astype(int)
        profile = np.bincount(rows - rows.min()).astype(float)
        return float((np.diff(profile) ** 2).sum())

    best, span = 0.0, limit
    for fineness in (1.0, 0.2, 0.05):
        tried = best + np.arange(-span, span + fineness / 2, fineness)
        best = float(max(tried, key=lambda d: (sharpness(d), -abs(d))))
        span = fineness
    return round(best, 3)
