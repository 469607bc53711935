import struct
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest

from folioforge import backends, cli
from folioforge.codecs import jpeg, pdf, png, raster
from folioforge.operators.inventory import inventory
from folioforge.operators.selection import Selection, parse
from folioforge.plans import documents, report
from folioforge.sources import dirlist, pdfpages
from folioforge.streaming.new_files import new_files


def jpeg_header(width, height):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc4\x00\x04cd\xff\xc0\x00\x11\x08" + struct.pack(">HH", height, width) + b"\x03" + b"\x01\x11\x00" * 3 + b"\xff\xd9"


def picture(width=240, height=170):
    y, x = np.mgrid[0:height, 0:width]
    return np.stack([x % 256, y % 256, (x + y) % 256], axis=2).astype(np.uint8)


def document(sizes, image=True):
    w = pdf.Writer()
    for width, height in sizes:
        w.page(width, height, png.encode(picture()) if image else None, b"BT (text) Tj ET")
    return w.data()


MIXED = [(595, 842), (1190, 842), (595, 842)]


def test_png_round_trip():
    r = np.random.default_rng(0)
    for shape in ((5, 7), (5, 7, 3), (4, 3, 4), (1, 1, 2)):
        pixels = r.integers(0, 256, shape).astype(np.uint8)
        assert (png.decode(png.encode(pixels)) == pixels).all()
    assert round(png.dpi(png.encode(picture(), 300))) == 300
    assert (png.decode(png.blank(10, 12)) == 255).all() and png.size(png.blank(10, 12)) == (10, 12)


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    pixels = picture(9, 6).reshape(6, -1).astype(int)
    rows = np.zeros_like(pixels)
    for y in range(6):
        for x in range(27):
            a, b = pixels[y, x - 3] if x > 2 else 0, pixels[y - 1, x] if y else 0
            c = pixels[y - 1, x - 3] if y and x > 2 else 0
            p = a + b - c
            near = min((abs(p - v), i, v) for i, v in enumerate((a, b, c)))[2]
            rows[y, x] = (pixels[y, x] - (0, a, b, (a + b) // 2, near)[kind]) % 256
    assert (png.unfilter(np.full(6, kind), rows.astype(np.uint8), 3) == pixels).all()


def test_jpeg_dimensions():
    assert jpeg.dimensions(jpeg_header(240, 170)) == (240, 170)
    for bad in (b"", b"PNG", b"\xff\xd8\xff\xd9", b"\xff\xd8\xff\xe0\x00\x04ab"):
        with pytest.raises(ValueError):
            jpeg.dimensions(bad)


def test_raster():
    p = picture()
    assert (raster.resize(p, 240, 170) == p).all() and raster.resize(p, 480, 340).shape == (340, 480, 3)
    assert (raster.crop(p, 10, 20, 30, 40) == p[20:60, 10:40]).all()
    assert raster.rotate(p, 90).shape == (240, 170, 3) and (raster.rotate(p, 90) == np.rot90(p)).all()
    flat = np.full((40, 60), 200, np.uint8)
    assert (raster.resize(flat, 90, 25) == 200).all() and raster.skew(flat) is None


@pytest.mark.parametrize("angle", [-4.0, 0.0, 2.5])
def test_skew_is_found(angle):
    page = np.full((400, 300), 255, np.uint8)
    for y in range(40, 360, 20):
        page[y : y + 4, 30:270] = 0
    turned = raster.rotate(page, -angle) if angle else page
    assert abs(raster.skew(turned) - angle) < 0.3


def test_pdf_round_trip():
    own = pdf.read(document(MIXED))
    assert [p.rect[2:] for p in own] == [tuple(map(float, s)) for s in MIXED]
    assert all((png.decode(p.images[0].data) == picture()).all() for p in own)
    assert own[0].contents[1] == b"BT (text) Tj ET"
    w = pdf.Writer()
    w.page(100, 50, jpeg_header(240, 170))
    image = pdf.read(w.data())[0].images[0]
    assert (image.ext, image.width, image.height, image.data) == ("jpeg", 240, 170, jpeg_header(240, 170))
    for bad in (b"", b"%PDF-1.4"):
        with pytest.raises(ValueError):
            pdf.read(bad)
    with pytest.raises(ValueError):
        pdf.from_images([])


def test_split():
    pages = pdf.read(document(MIXED))
    out = documents.split(pages)
    assert [round(p.width) for p in out] == [595, 595, 595, 595]
    halves = [png.decode(p.image) for p in out[1:3]]
    assert (np.concatenate(halves, axis=1) == picture()).all()
    assert len(documents.split(pages, Selection("list", (0,)))) == 1 and len(documents.split(pages, parse("0:2"))) == 3
    # Spreads without an image are left out, other pages stay.
    assert len(documents.split(pdf.read(document(MIXED, image=False)))) == 2
    with pytest.raises(ValueError):
        documents.split(pages, Selection("list", (7,)))


def test_pictures_are_numbered_by_box(tmp_path):
    documents.split(pdf.read(document(MIXED)), pictures=str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"page_{i:04d}.png" for i in range(4)]


def test_tiny_crops_are_blank():
    image = pdf.Image("png", 12, 30, png.encode(picture(12, 30)))
    data, ext = documents.crop(image, pdf.Page((0, 0, 100, 50)), (0, 0, 50, 50))
    assert ext == "png" and png.size(data) == (10, 30) and (png.decode(data) == 255).all()


def test_prepared():
    out = documents.prepared(documents.split(pdf.read(document([(595, 842)]))), 2.0)
    assert png.size(out[0].image) == (480, 340)
    dpi = int((240 / (595 / 72) + 170 / (842 / 72)) / 2 * 2)
    assert out[0].width == pytest.approx(480 * 72 / dpi)


def test_text_transfer():
    pages = [documents.Output(10, 10, None, b"own"), documents.Output(10, 10)]
    layer = pdf.Page((0, 0, 10, 10), contents=[b"q /OCR-x Do Q"], objects={"OCR-x": b"BT A ET\n/Im0 Do\nBT B ET", "Im0": b"no"}, fonts=["F"])
    out = documents.with_text(pages, [layer])
    assert out[0].text == b"own\nBT A ET\nBT B ET" and out[0].fonts == ["F"] and out[1] is pages[1]


TO_UNICODE = "1 beginbfchar\n<0001> <041F>\nendbfchar".encode()


def made_by_hand(objects):
    """A file of these object bodies, the first of which is the catalogue."""
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i, o) for i, o in enumerate(objects, 1)) + b"trailer << /Root 1 0 R >>\n"


def stream(entries, data):
    return b"<< %s /Length %d >>\nstream\n%s\nendstream" % (entries, len(data), data)


def recognised():
    """A page whose text is drawn by a form with a font of its own, in Cyrillic letters."""
    return made_by_hand([
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 100 50] /Resources << /XObject << /OCR-1 5 0 R >> >> /Contents 4 0 R >>",
        stream(b"", b"q /OCR-1 Do Q"), stream(b"/Type /XObject /Subtype /Form /Resources << /Font << /f-0-0 6 0 R >> >>", b"BT /f-0-0 9 Tf <0001> Tj ET"),
        b"<< /Type /Font /Subtype /Type0 /BaseFont /Own /Encoding /Identity-H /ToUnicode 7 0 R /DescendantFonts [8 0 R] >>",
        stream(b"", TO_UNICODE), b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Own /CIDSystemInfo << /Registry (Adobe) /Ordering (Identity) /Supplement 0 >> >>",
    ])


def test_fonts_come_with_the_text():
    parts = documents.split(pdf.read(document([(100, 50)])[:]), settings=documents.Settings(spread_ratio=9))
    page = pdf.read(documents.assembled(documents.with_text(parts, pdf.read(recognised()))))[0]
    own = page.document.resolved
    font = own(page.font_objects["f-0-0"])
    assert font["Subtype"] == "Type0" and page.document.decoded(own(font["ToUnicode"])) == TO_UNICODE
    assert own(own(font["DescendantFonts"])[0])["CIDSystemInfo"]["Registry"] == b"Adobe"
    assert page.contents[-1] == b"BT /f-0-0 9 Tf <0001> Tj ET" and b"BT (text) Tj ET" in page.contents and len(page.images) == 1


@pytest.mark.parametrize("turn, size, matrix", [(0, (100, 200), "1 0 0 1 -10 -20"), (90, (200, 100), "0 -1 1 0 -20 110"), (180, (100, 200), "-1 0 0 -1 110 220"), (270, (200, 100), "0 1 -1 0 220 -10")])
def test_whole_pages_are_taken_over(turn, size, matrix):
    image = b"/Type /XObject /Subtype /Image /Width 1 /Height 2 /ColorSpace /DeviceGray /BitsPerComponent 8"
    data = made_by_hand([
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 /Resources 7 0 R >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 300 400] /CropBox [110 220 10 20] /Rotate %d /Contents [4 0 R] >>" % turn,
        stream(b"", b"/A Do /B Do BT /F#20x 9 Tf (own) Tj ET"), stream(image, b"ab"), stream(image, b"cd"),
        b"<< /XObject << /A 5 0 R /B 6 0 R >> /Font << /F#20x << /Type /Font /Subtype /Type1 /BaseFont /Times-Roman /Parent 3 0 R >> >> /ExtGState << /G << /CA 0.5 /SA true /X null >> >> >>",
    ])
    parts = documents.split(pdf.read(data), settings=documents.Settings(spread_ratio=9))
    page = pdf.read(documents.assembled(parts))[0]
    assert page.rect == (0, 0, *size) and page.rotation == 0
    assert [float(x) for x in page.contents[0].split()[1:7]] == [float(x) for x in matrix.split()]
    assert page.contents[1] == b"/A Do /B Do BT /F#20x 9 Tf (own) Tj ET"
    assert [png.decode(i.data).ravel().tolist() for i in page.images] == [[97, 98], [99, 100]]
    assert page.document.resolved(page.font_objects["F x"])["BaseFont"] == "Times-Roman"
    assert page.document.resolved(page.resources["ExtGState"])["G"] == {"CA": 0.5, "SA": True, "X": None}
    assert len(pdf.read(documents.assembled(parts + parts))) == 2


def test_halves_of_a_jpeg(tmp_path):
    if backends.available(documents.DEFAULTS.lossless_cropper):
        pytest.skip("a lossless cropper is installed")
    w = pdf.Writer()
    w.page(1190, 842, jpeg_header(240, 170))
    pages = pdf.read(w.data())
    out = documents.split(pages)
    assert [(p.width, p.place) for p in out] == [(595, (0, 0, 1190, 842)), (595, (-595, 0, 1190, 842))]
    data = documents.assembled(documents.prepared(out))
    own = pdf.read(data)
    assert [(len(p.images), p.rect[2]) for p in own] == [(1, 595), (1, 595)] and data.count(b"DCTDecode") == 1
    assert own[1].contents[0].split()[:8] == b"q 0 0 595.0000 842.0000 re W n".split()
    with pytest.raises(backends.Unavailable):
        documents.split(pages, pictures=str(tmp_path))


@pytest.fixture
def tree(tmp_path):
    for name in ("root.pdf", "sub1/a.pdf", "sub2/deep/a.pdf", "sub1/.hidden/_b.pdf", "other.PDF"):
        documents.write(tmp_path / "src" / name, document(MIXED))
    return tmp_path


def test_process_directory_without_backend(spark, tree):
    if backends.available("ocrmypdf"):
        pytest.skip("a recognition backend is installed")
    out = documents.process_directory(spark, str(tree / "src"), str(tree / "out"))
    assert set(out) == {"root.pdf", "a.pdf", "_b.pdf"} and all("no recognition backend" in e for e in out.values())
    assert not list((tree / "out").rglob("*.pdf"))
    rows = documents.batch_results(spark, str(tree / "src"), str(tree / "out"), only_pictures=True).collect()
    assert len(rows) == 4 and all(r.error is None for r in rows)
    assert len(list((tree / "out" / "sub2" / "deep" / "a.page_pics").iterdir())) == 4
    (tree / "empty").mkdir()
    assert documents.process_directory(spark, str(tree / "empty"), str(tree / "out")) == {}
    with pytest.raises(NotADirectoryError):
        documents.process_directory(spark, str(tree / "none"), str(tree / "out"))


def test_process_single_pdf(tree, monkeypatch):
    with pytest.raises(FileNotFoundError):
        documents.process_single_pdf(tree / "no.pdf", tree / "x.pdf")
    monkeypatch.setattr(backends, "recognise", lambda data, *options: data)
    done = documents.process_single_pdf(tree / "src/root.pdf", tree / "new/dir/x.pdf", parse("1"), intermediate_pdf_path=str(tree / "split.pdf"))
    assert len(pdf.read(Path(done).read_bytes())) == len(pdf.read((tree / "split.pdf").read_bytes())) == 2
    assert cli.main(["single", str(tree / "src/root.pdf"), str(tree / "y.pdf"), "--pages", "0"]) == 0
    assert cli.main(["single", str(tree / "no.pdf"), str(tree / "y.pdf")]) == 1


def test_listing_sees_every_name(spark, tree):
    seen = {r.rel_path for r in dirlist.listing(spark, str(tree / "src"), recursive=True).where("is_file").collect()}
    assert seen == {"root.pdf", "sub1/a.pdf", "sub2/deep/a.pdf", "sub1/.hidden/_b.pdf", "other.PDF"}
    assert dirlist.listing(spark, str(tree / "none"), missing_ok=True).count() == 0


def test_pages_source(spark, tree):
    documents.write(tree / "bad.pdf", b"no")
    files = spark.createDataFrame([(str(tree / "src/root.pdf"),), (str(tree / "bad.pdf"),)], "path string")
    rows = pdfpages.pages_of(files).collect()
    assert [(r.page_idx, len(r.images)) for r in rows if r.error is None] == [(0, 1), (1, 1), (2, 1)]
    assert [r.error for r in rows if r.error] == ["not a PDF file"]


def test_assembly(spark, tmp_path):
    for name in ("one/_p2-4x.png", "one/_p1-4x.png", "two/p.png", "done/_p-4x.png"):
        documents.write(tmp_path / "in" / name, png.encode(picture(), 300))
    documents.write(tmp_path / "out/done.pdf", b"x")
    rows = documents.assemble_directories(spark, str(tmp_path / "in"), str(tmp_path / "out"), extensions=["png"]).collect()
    assert {r.dir: r.status for r in rows} == {"one": "done", "two": "skipped"}
    assert len(pdf.read((tmp_path / "out/one.pdf").read_bytes())) == 2


def test_report(spark, tmp_path):
    files = [("a", "p.jpg"), ("a", "q.jpg"), ("a", "_p-gigapixel-x-2x.jpg"), ("b", "p.jpg"), ("c", "i.djvu")]
    text = report.render(inventory(spark.createDataFrame(files, "dir string, name string")), datetime(2020, 1, 2, 3, 4, 5))
    assert "2020-01-02 03:04:05" in text and "| a | 2 | 1 | 50% | `-gigapixel-x-2x` |" in text and "| b | 1 | 0 | — | — |" in text
    for d, n in files:
        documents.write(tmp_path / "tree" / d / n, b"")
    documents.write(tmp_path / "tree/.hidden/p.jpg", b"")
    assert cli.main(["inventory", str(tmp_path / "tree"), str(tmp_path / "report.md")]) == 0
    assert "- Directories: 3" in (tmp_path / "report.md").read_text()


def test_new_files_stream(spark, tmp_path):
    root = tmp_path / "in"
    documents.write(root / "_a.pdf", b"1")

    def run():
        q = new_files(spark, str(root)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(once=True).start()
        q.awaitTermination(120)
        return sorted(r.rel_path for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["_a.pdf"]
    documents.write(root / "sub/b.pdf", b"2")
    assert run() == ["_a.pdf", "sub/b.pdf"]
