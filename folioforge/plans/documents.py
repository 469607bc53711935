"""One document's way: split spreads, prepare images, recognise, move the text layer; and batches of it in Spark."""

from __future__ import annotations

import logging
import os
import subprocess
import uuid
from dataclasses import dataclass, field, replace
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge import backends
from folioforge.codecs import pdf, png, raster
from folioforge.config import DEFAULTS, Settings
from folioforge.functions.names import path_order
from folioforge.operators import assembly, batch, textlayer
from folioforge.operators.selection import Selection
from folioforge.sources import dirlist

log = logging.getLogger(__name__)


@dataclass
class Output:
    """A page on its way: its rectangle's size, its picture (None: nothing to draw), its text and fonts.

    source is the page that is taken over whole, before the text; place is where the picture lies if it is larger
    than the page; objects are the fonts' documents and values, by name.
    """

    width: float
    height: float
    image: bytes | None = None
    text: bytes = b""
    fonts: list[str] = field(default_factory=list)
    ext: str = "png"
    source: pdf.Page | None = None
    place: tuple[float, float, float, float] | None = None
    objects: dict = field(default_factory=dict)


def write(path: str | Path, data: bytes) -> Path:
    """The whole file or nothing: what a failure leaves is never taken for a result."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        part.write_bytes(data)
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)
    return path


def boxes(page: pdf.Page, settings: Settings = DEFAULTS) -> list[tuple[float, float, float, float]]:
    x0, y0, x1, y1 = page.rect
    if y1 > y0 and (x1 - x0) / (y1 - y0) >= settings.spread_ratio:
        middle = x0 + (x1 - x0) / 2
        return [(x0, y0, middle, y1), (middle, y0, x1, y1)]
    return [(x0, y0, x1, y1)]


def crop(image: pdf.Image, page: pdf.Page, box: tuple[float, float, float, float], settings: Settings = DEFAULTS) -> tuple[bytes, str]:
    """(bytes, extension) of the box's part of a page image."""
    x0, y0, x1, y1 = page.rect
    sx, sy = image.width / (x1 - x0), image.height / (y1 - y0)
    left, top, right, bottom = int((box[0] - x0) * sx), int((box[1] - y0) * sy), int((box[2] - x0) * sx), int((box[3] - y0) * sy)
    width, height = right - left, bottom - top
    if width < settings.least_crop or height < settings.least_crop:
        return png.blank(max(width, settings.least_crop), max(height, settings.least_crop)), "png"
    if image.ext in ("jpg", "jpeg") and backends.available(settings.lossless_cropper):
        try:
            return backends.lossless_crop(image.data, f"{width}x{height}+{left}+{top}", settings.lossless_cropper), "jpg"
        except subprocess.CalledProcessError as e:
            log.warning("lossless crop failed, decoding instead: %s", e)
    if image.ext != "png":
        raise backends.Unavailable(f"no decoder for {image.ext} images")
    return png.encode(raster.crop(png.decode(image.data), left, top, width, height)), "png"


def selected(pages: list[pdf.Page], selection: Selection) -> list[pdf.Page]:
    """Selected pages in the selection's order; one that takes exactly all pages leaves the document as it is."""
    if selection.kind == "all":
        return pages
    if selection.kind == "slice":
        if selection.step == 0:
            raise ValueError("a slice's step can't be 0")
        wanted = list(range(*slice(selection.start, selection.stop, selection.step).indices(len(pages))))
    else:
        wanted = list(selection.pages)
    if any(not 0 <= i < len(pages) for i in wanted):
        raise ValueError(f"a selected page is missing; the document has {len(pages)}")
    return pages if set(wanted) == set(range(len(pages))) else [pages[i] for i in wanted]


def split(pages: list[pdf.Page], selection: Selection = Selection(), pictures: str | None = None, settings: Settings = DEFAULTS) -> list[Output]:
    """A page per box; pictures, if named, gets each box's image.

    Pages of one box are taken over whole. Halves of a page without an image are left out. A half of an image that
    nothing here can cut shows its part of the whole image; as a picture of its own it is an error.
    """
    out = []
    number = -1
    for page in selected(pages, selection):
        own = boxes(page, settings)
        for box in own:
            number += 1
            width, height = box[2] - box[0], box[3] - box[1]
            whole = all(abs(a - b) < settings.edge_slack for a, b in zip(box, page.rect))
            if whole:
                image = page.images[0] if page.images and page.images[0].ext in ("png", "jpeg") else None
                out.append(Output(width, height, image and image.data, b"", list(page.fonts), image.ext if image else "png", page))
                if image is None and pictures:
                    log.warning("box %d has no picture to save", number)
                    continue
            elif not page.images:
                log.warning("box %d of a spread without an image is left out", number)
                continue
            else:
                image, place = page.images[0], None
                try:
                    data, ext = crop(image, page, box, settings)
                except backends.Unavailable:
                    if pictures or image.ext != "jpeg":
                        raise
                    x0, y0, x1, y1 = page.rect
                    data, ext, place = image.data, image.ext, (x0 - box[0], box[3] - y1, x1 - x0, y1 - y0)
                out.append(Output(width, height, data, b"", [], ext, place=place))
            if pictures:
                write(Path(pictures, f"page_{number:04d}.{out[-1].ext}"), out[-1].image)
    return out


def assembled(pages: list[Output]) -> bytes:
    w = pdf.Writer()
    for p in pages:
        if p.source is not None:
            w.copy(p.source, p.text, tuple(p.fonts), p.objects)
        else:
            w.page(p.width, p.height, p.image, p.text, tuple(p.fonts), p.objects, p.place)
    return w.data()


def prepared(pages: list[Output], ratio: float = DEFAULTS.upscale, deskew: bool = False, settings: Settings = DEFAULTS) -> list[Output]:
    """Pages with upscaled and levelled pictures, each as large as its picture at its new resolution."""
    out = []
    for p in pages:
        if p.image is None or p.image[:8] != png.SIGNATURE:  # nothing here decodes others
            if p.image is not None:
                log.warning("a %s picture is neither upscaled nor levelled: no decoder", p.ext)
            out.append(p)
            continue
        pixels = raster.normalised(png.decode(p.image))
        height, width = pixels.shape[:2]
        dpi = int((width / (p.width / 72) + height / (p.height / 72)) / 2 * ratio)
        angle = 0.0
        if deskew:
            try:
                found = raster.skew(pixels)
                angle = found if found is not None and settings.skew_ignored < abs(found) <= settings.skew_limit else 0.0
            except (ValueError, FloatingPointError) as e:
                log.warning("skew is unknown: %s", e)
        if abs(ratio - 1) > 0.01:
            pixels = raster.resize(pixels, int(width * ratio), int(height * ratio))
        if abs(angle) > settings.skew_ignored:
            pixels = raster.rotate(pixels, angle)
        out.append(Output(pixels.shape[1] * 72 / dpi, pixels.shape[0] * 72 / dpi, png.encode(np.ascontiguousarray(pixels), dpi)))
    return out


def layer_text(page: pdf.Page) -> bytes:
    """A recognised page's text objects without their image lines, once per stream that draws one."""
    mark, image, draw = (x.encode() for x in (textlayer.OBJECT, textlayer.IMAGE, textlayer.DRAW))
    kept = [b"\n".join(x for x in body.split(b"\n") if not (image in x and draw in x)) for name, body in sorted(page.objects.items()) if f"/{name}".startswith(textlayer.OBJECT)]
    return b"\n".join(k for s in page.contents if mark in s and draw in s for k in kept)


def with_text(pages: list[Output], recognised: list[pdf.Page]) -> list[Output]:
    """Pages with the text of the recognised page of the same place after their contents; surplus ones are lost."""
    if len(pages) != len(recognised):
        log.warning("%d pages and %d recognised ones", len(pages), len(recognised))
    out = []
    for p, r in zip(pages, recognised):
        text = layer_text(r)
        new = [f for f in r.fonts if text and f not in p.fonts]
        objects = {f: (r.document, r.font_objects[f]) for f in new if f in r.font_objects}
        out.append(replace(p, text=b"\n".join(filter(None, [p.text, text])), fonts=p.fonts + new, objects=p.objects | objects))
    return out + pages[len(recognised) :]


def process_single_pdf(src: str | Path, dst: str | Path, pages: Selection = Selection(), language: str = DEFAULTS.language, upscale_ratio: float = DEFAULTS.upscale, deskew: bool = True, clean: bool = True, rotate_pages: bool = True, intermediate_pdf_path: str | None = None, second_intermediate_pdf_path: str | None = None, intermediate_page_pics_dir: str | None = None, only_pictures: bool = False) -> Path:
    """dst: the document split into single pages, with a text layer. Errors are raised, also a missing backend."""
    src, dst = Path(src), Path(dst)
    if not src.is_file():
        raise FileNotFoundError(str(src))
    parts = split(pdf.read(src.read_bytes()), pages, intermediate_page_pics_dir)
    if intermediate_pdf_path:
        write(intermediate_pdf_path, assembled(parts))
    if only_pictures:
        return dst
    ready = assembled(prepared(parts, upscale_ratio, deskew))
    if second_intermediate_pdf_path:
        write(second_intermediate_pdf_path, ready)
    recognised = pdf.read(backends.recognise(ready, language, deskew, clean, rotate_pages))
    return write(dst, assembled(with_text(parts, recognised)))


def batch_results(spark: SparkSession, src_dir: str, dst_dir: str, language: str = DEFAULTS.language, upscale_ratio: float = DEFAULTS.upscale, deskew: bool = True, clean: bool = True, rotate_pages: bool = True, save_pictures: bool = False, only_pictures: bool = False, partitions: int | None = None) -> DataFrame:
    """rel_path, file_name, error for every `*.pdf` below src_dir, the outputs in the same tree below dst_dir."""
    if not os.path.isdir(src_dir):
        raise NotADirectoryError(src_dir)
    found = dirlist.listing(spark, src_dir, recursive=True).where("endswith(name, '.pdf')")
    todo = batch.tasks(found.orderBy(path_order(F.col("rel_path"))), dst_dir, save_pictures, only_pictures)

    def work(row: dict) -> None:
        process_single_pdf(row["source"], row["target"], language=language, upscale_ratio=upscale_ratio, deskew=deskew, clean=clean, rotate_pages=rotate_pages, intermediate_page_pics_dir=row["pictures"], only_pictures=row["only_pictures"])

    return batch.run_tasks(todo, work, partitions)


def process_directory(spark: SparkSession, src_dir: str, dst_dir: str, **options) -> dict[str, str | None]:
    """File name to error (None: done). Files of one name in several folders share an entry, the last's."""
    os.makedirs(dst_dir, exist_ok=True)
    rows = sorted(batch_results(spark, src_dir, dst_dir, **options).collect(), key=lambda r: r["rel_path"].split("/"))
    out = {r["file_name"]: r["error"] for r in rows}
    log.info("%d done, %d failed", sum(e is None for e in out.values()), sum(e is not None for e in out.values()))
    return out


def images_to_pdf(paths: list[str], dest: str | Path) -> Path:
    """One page per image, in name order. ValueError without images."""
    if not paths:
        raise ValueError("no image matches")
    return write(dest, pdf.from_images([Path(p).read_bytes() for p in sorted(paths)]))


def assemble_directories(spark: SparkSession, root: str, dest_dir: str, **choice) -> DataFrame:
    """dir, pdf_name, status (done, skipped or error) and error of each folder below root whose PDF isn't there yet."""
    files = dirlist.children(spark, root)
    existing = dirlist.listing(spark, dest_dir, missing_ok=True).select(F.col("name").alias("pdf_name"))
    chosen = assembly.assembly_filter(files, **choice).groupBy("dir").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    folders = dirlist.listing(spark, root).where("is_dir").select(F.col("name").alias("dir"), F.concat("name", F.lit(".pdf")).alias("pdf_name"))
    wanted = assembly.todo(folders.join(chosen, "dir", "left"), existing).repartition(max(1, spark.sparkContext.defaultParallelism))

    def run(frames):
        for frame in frames:
            status, error = [], []
            for row in frame.to_dict("records"):
                try:
                    images_to_pdf(list(row["paths"]) if row["paths"] is not None else [], Path(dest_dir, row["pdf_name"]))
                    status.append("done"), error.append(None)
                except ValueError as e:
                    status.append("skipped"), error.append(str(e))
                except Exception as e:  # the folder's result
                    status.append("error"), error.append(str(e))
            yield frame.assign(status=status, error=error)[["dir", "pdf_name", "status", "error"]]

    return wanted.mapInPandas(run, "dir string, pdf_name string, status string, error string")
