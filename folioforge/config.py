"""Settings as an immutable record; plans take them as literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # A page at least this wide for its height is a spread; recognition language and upscaling.
    spread_ratio: float = 288 / 250
    language: str = "rus"
    upscale: float = 2.0
    render_dpi: int = 300
    least_crop: int = 10
    edge_slack: float = 1.0
    skew_ignored: float = 0.1
    skew_limit: float = 40.0
    lossless_cropper: str = "jpegtran"


DEFAULTS = Settings()
