"""Outside programs, found at run time. What isn't there is said so; nothing stands in for it."""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from pathlib import Path

from folioforge.config import DEFAULTS


class Unavailable(RuntimeError):
    pass


def available(program: str) -> bool:
    return shutil.which(program) is not None


def lossless_crop(data: bytes, spec: str, program: str = DEFAULTS.lossless_cropper) -> bytes:
    """The JPEG part that spec (WxH+X+Y) names, without decoding."""
    if not available(program):
        raise Unavailable(f"{program} is not installed")
    with tempfile.TemporaryDirectory() as folder:
        source, target = Path(folder, "in.jpg"), Path(folder, "out.jpg")
        source.write_bytes(data)
        subprocess.run([program, "-copy", "all", "-crop", spec, "-outfile", str(target), str(source)], check=True, capture_output=True)
        return target.read_bytes()


def recognise(data: bytes, language: str, deskew: bool, clean: bool, rotate_pages: bool, program: str = "ocrmypdf") -> bytes:
    """A PDF's bytes with a text layer. One job each: the plan's partitions are what runs in parallel."""
    if not available(program):
        raise Unavailable(f"no recognition backend: {program} is not installed")
    flags = [f for f, on in (("--deskew", deskew), ("--clean", clean), ("--rotate-pages", rotate_pages)) if on]
    with tempfile.TemporaryDirectory() as folder:
        source, target = Path(folder, "in.pdf"), Path(folder, "out.pdf")
        source.write_bytes(data)
        subprocess.run([program, "-l", language, "--skip-text", "--optimize", "0", "--jobs", "1", "--quiet", *flags, str(source), str(target)], check=True, capture_output=True)
        return target.read_bytes()
