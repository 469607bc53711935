"""A small PDF reader and writer: pages, rectangles, embedded images, content streams, fonts.

The reader finds objects by scanning, follows object streams, and undoes Flate with predictors; it serves files
without encryption. The writer embeds JPEG data as it is and other images as Flate-compressed pixels.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np

from folioforge.codecs import jpeg, png


class Name(str):
    """A PDF name, without its slash."""


@dataclass(frozen=True)
class Ref:
    number: int


@dataclass
class Stream:
    entries: dict
    raw: bytes


TOKEN = re.compile(rb"\s*(?:%[^\r\n]*\s*)*(<<|>>|\[|\]|\(|<[0-9A-Fa-f\s]*>|/[^\s()<>\[\]{}/%]*|[^\s()<>\[\]{}/%]+)")
OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _name(t: bytes) -> Name:
    return Name(re.sub(r"#([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), t[1:].decode("latin-1")))


class Parser:
    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def token(self) -> bytes | None:
        m = TOKEN.match(self.data, self.at)
        if not m:
            return None
        self.at = m.end()
        return m[1]

    def string(self) -> bytes:
        out, depth = bytearray(), 1
        while self.at < len(self.data):
            c = self.data[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                m = re.compile(rb"[0-7]{1,3}|\r\n|.", re.S).match(self.data, self.at)
                self.at = m.end()
                out += bytes([int(m[0], 8) & 255]) if m[0][0:1].isdigit() else ESCAPES.get(m[0], b"" if m[0] in (b"\n", b"\r", b"\r\n") else m[0])
                continue
            depth += (c == b"(") - (c == b")")
            if not depth:
                break
            out += c
        return bytes(out)

    def value(self, t: bytes | None = None):
        t = self.token() if t is None else t
        if t is None:
            raise ValueError("a PDF object ends early")
        if t == b"<<":
            out = {}
            while (k := self.token()) != b">>":
                if k is None:
                    raise ValueError("a PDF dictionary ends early")
                out[_name(k)] = self.value()
            return out
        if t == b"[":
            out = []
            while (k := self.token()) != b"]":
                if k is None:
                    raise ValueError("a PDF array ends early")
                out.append(self.value(k))
            return out
        if t == b"(":
            return self.string()
        if t[:1] == b"<":
            digits = re.sub(rb"\s", b"", t[1:-1])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if t[:1] == b"/":
            return _name(t)
        if re.fullmatch(rb"[+-]?\d+", t):
            m = re.compile(rb"\s+\d+\s+R(?![^\s()<>\[\]{}/%])").match(self.data, self.at)
            if m and t.isdigit():
                self.at = m.end()
                return Ref(int(t))
            return int(t)
        if re.fullmatch(rb"[+-]?(\d+\.\d*|\.\d+)", t):
            return float(t)
        return {b"true": True, b"false": False, b"null": None}.get(t, t)


@dataclass
class Image:
    ext: str
    width: int
    height: int
    data: bytes


@dataclass
class Page:
    rect: tuple[float, float, float, float]
    rotation: int = 0
    images: list[Image] = field(default_factory=list)
    contents: list[bytes] = field(default_factory=list)
    objects: dict[str, bytes] = field(default_factory=dict)
    fonts: list[str] = field(default_factory=list)
    #: Of a page that was read: its document, visible box, resources, content references, and fonts by name.
    document: Document | None = None
    box: tuple[float, float, float, float] | None = None
    resources: dict = field(default_factory=dict)
    streams: list = field(default_factory=list)
    font_objects: dict = field(default_factory=dict)


class Document:
    def __init__(self, data: bytes):
        if b"%PDF-" not in data[:1024]:
            raise ValueError("not a PDF file")
        self.data, self.objects = data, {}
        for m in OBJECT.finditer(data):  # the last of a number wins, as in updated files
            try:
                self.objects[int(m[1])] = self._object(m.end())
            except (ValueError, AttributeError):
                continue
        for s in [o for o in self.objects.values() if isinstance(o, Stream) and o.entries.get("Type") == "ObjStm"]:
            body = self.decoded(s)
            numbers = [int(x) for x in body[: self.resolved(s.entries["First"])].split()]
            for number, at in zip(numbers[::2], numbers[1::2]):
                self.objects.setdefault(number, Parser(body, self.resolved(s.entries["First"]) + at).value())

    def _object(self, at: int):
        p = Parser(self.data, at)
        value = p.value()
        m = re.compile(rb"\s*stream\r?\n").match(self.data, p.at)
        if not isinstance(value, dict) or not m:
            return value
        n = value.get("Length")
        if isinstance(n, Ref):
            m2 = re.search(rb"(?<!\d)%d\s+0\s+obj\s+(\d+)" % n.number, self.data)
            n = int(m2[1]) if m2 else None
        if n is None or not re.compile(rb"\s*endstream").match(self.data, m.end() + n):
            n = self.data.find(b"endstream", m.end()) - m.end()
        return Stream(value, self.data[m.end() : m.end() + n])

    def resolved(self, x):
        for _ in range(32):
            if not isinstance(x, Ref):
                return x
            x = self.objects.get(x.number)
        return None

    def decoded(self, s: Stream) -> bytes:
        """Without its Flate filters; other filters leave the data as they are."""
        data, filters, parms = s.raw, self.resolved(s.entries.get("Filter")), self.resolved(s.entries.get("DecodeParms"))
        filters = filters if isinstance(filters, list) else [filters] if filters else []
        parms = parms if isinstance(parms, list) else [parms]
        for f, p in zip(filters, parms + [None] * len(filters)):
            if f == "FlateDecode":
                data = zlib.decompressobj().decompress(data)
                p = self.resolved(p) or {}
                if p.get("Predictor", 1) >= 10:
                    step = max(1, p.get("Colors", 1) * p.get("BitsPerComponent", 8) // 8)
                    rows = np.frombuffer(data, np.uint8).reshape(-1, 1 + p.get("Columns", 1) * step)
                    data = png.unfilter(rows[:, 0], rows[:, 1:], step).tobytes()
        return data

    def _image(self, s: Stream) -> Image:
        e = {k: self.resolved(v) for k, v in s.entries.items()}
        width, height, filters = e["Width"], e["Height"], e.get("Filter")
        last = filters[-1] if isinstance(filters, list) and filters else filters
        if last == "DCTDecode":
            return Image("jpeg", width, height, self.decoded(s))
        data, space = self.decoded(s), e.get("ColorSpace")
        channels = {"DeviceGray": 1, "DeviceRGB": 3}.get(space)
        if isinstance(space, list) and self.resolved(space[0]) == "ICCBased":
            channels = self.resolved(self.resolved(space[1]).entries.get("N"))
        if channels in (1, 3) and e.get("BitsPerComponent") == 8 and len(data) >= width * height * channels and last in (None, "FlateDecode"):
            pixels = np.frombuffer(data, np.uint8, width * height * channels).reshape(height, width, channels)
            return Image("png", width, height, png.encode(pixels))
        return Image("raw", width, height, s.raw)

    def pages(self) -> list[Page]:
        roots = [o for o in self.objects.values() if isinstance(o, dict) and o.get("Type") == "Catalog"]
        if not roots:
            raise ValueError("a PDF file without a catalogue")
        out: list[Page] = []
        todo, seen = [(roots[-1].get("Pages"), {})], set()
        while todo:
            ref, inherited = todo.pop()
            if isinstance(ref, Ref):
                if ref.number in seen:
                    continue
                seen.add(ref.number)
            node = self.resolved(ref)
            if not isinstance(node, dict):
                continue
            own = inherited | {k: node[k] for k in ("MediaBox", "CropBox", "Rotate", "Resources") if k in node}
            kids = self.resolved(node.get("Kids"))
            if isinstance(kids, list):
                todo += [(k, own) for k in reversed(kids)]
            else:
                out.append(self._page(node, own))
        return out

    def _page(self, node: dict, own: dict) -> Page:
        box = self._box(own.get("MediaBox")) or (0.0, 0.0, 612.0, 792.0)
        if seen := self._box(own.get("CropBox")):  # what of it lies on the medium
            seen = (max(box[0], seen[0]), max(box[1], seen[1]), min(box[2], seen[2]), min(box[3], seen[3]))
            box = seen if seen[0] < seen[2] and seen[1] < seen[3] else box
        rotation = (self.resolved(own.get("Rotate")) or 0) % 360
        width, height = box[2] - box[0], box[3] - box[1]
        page = Page((0.0, 0.0, *((height, width) if rotation in (90, 270) else (width, height))), rotation, document=self, box=box)
        contents = self.resolved(node.get("Contents"))
        for c in contents if isinstance(contents, list) else [node.get("Contents")]:
            s = self.resolved(c)
            if isinstance(s, Stream):
                page.contents.append(self.decoded(s))
                page.streams.append(c)
        page.resources = resources = self.resolved(own.get("Resources")) or {}
        page.font_objects = dict(self.resolved(resources.get("Font")) or {})
        page.fonts = sorted(page.font_objects)
        for name, x in (self.resolved(resources.get("XObject")) or {}).items():
            x = self.resolved(x)
            if isinstance(x, Stream) and self.resolved(x.entries.get("Subtype")) == "Image":
                page.images.append(self._image(x))
            elif isinstance(x, Stream):
                page.objects[name] = self.decoded(x)
                inner = self.resolved(self.resolved(x.entries.get("Resources")) or {}) or {}
                page.font_objects = (self.resolved(inner.get("Font")) or {}) | page.font_objects
                page.fonts = sorted(page.font_objects)
        return page

    def _box(self, x) -> tuple[float, float, float, float] | None:
        """Left, bottom, right, top of a box, whichever corners name it."""
        x = self.resolved(x)
        if not isinstance(x, list) or len(x) != 4:
            return None
        a, b, c, d = (float(self.resolved(v)) for v in x)
        return min(a, c), min(b, d), max(a, c), max(b, d)


def read(data: bytes) -> list[Page]:
    return Document(data).pages()


def spelt(x, number) -> bytes:
    """A value in a file's syntax; number gives the number that a reference has there."""
    if isinstance(x, dict):
        return b"<< " + b"".join(spelt(Name(k), number) + b" " + spelt(v, number) + b" " for k, v in x.items()) + b">>"
    if isinstance(x, list):
        return b"[" + b" ".join(spelt(v, number) for v in x) + b"]"
    if isinstance(x, Ref):
        return b"%d 0 R" % number(x)
    if isinstance(x, Name):
        return b"/" + re.sub(rb"[^!-~]|[#()<>\[\]{}/%]", lambda m: b"#%02X" % m[0][0], x.encode("latin-1"))
    if isinstance(x, bytes):
        return b"<" + x.hex().encode() + b">"
    if x is None or isinstance(x, bool):
        return {None: b"null", True: b"true", False: b"false"}[x]
    return (f"{x:.6f}" if isinstance(x, float) else str(x)).encode()


class Writer:
    def __init__(self):
        self.bodies: list[bytes] = [b"", b""]  # catalogue and page tree come last
        self.kids: list[int] = []
        self.numbers: dict[tuple[Document, int], int] = {}  # of objects copied from other documents
        self.images: dict[bytes, int] = {}

    def copied(self, document: Document, x) -> bytes:
        """A value of another document, spelt for this file. All that it refers to comes along, once, but no other page."""
        todo = []

        def number(ref: Ref) -> int:
            if (document, ref.number) not in self.numbers:
                self.numbers[document, ref.number] = self._add(b"null")
                todo.append(ref.number)
            return self.numbers[document, ref.number]

        out = spelt(x, number)
        while todo:
            old = todo.pop()
            value = document.objects.get(old)
            if isinstance(value, Stream):
                body = spelt(value.entries | {"Length": len(value.raw)}, number) + b"\nstream\n" + value.raw + b"\nendstream"
            elif isinstance(value, dict) and value.get("Type") in ("Page", "Pages", "Catalog"):
                continue
            else:
                body = spelt(value, number)
            self.bodies[self.numbers[document, old] - 1] = body
        return out

    def _fonts(self, fonts: tuple[str, ...], objects: dict[str, tuple[Document, object]]) -> bytes:
        """The fonts' dictionary: objects (document, value) as they are, names without one as a standard font."""
        each = [spelt(Name(f), None) + b" " + (self.copied(*objects[f]) if f in objects else b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>") for f in fonts]
        return b" /Font << " + b" ".join(each) + b" >>" if each else b""

    def _finish(self, width: float, height: float, resources: bytes, contents: list[bytes]) -> None:
        self.kids.append(self._add(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.4f %.4f] /Resources <<%s >> /Contents [%s] >>" % (width, height, resources, b" ".join(contents))))

    def copy(self, page: Page, text: bytes = b"", fonts: tuple[str, ...] = (), objects: dict[str, tuple[Document, object]] | None = None) -> None:
        """A page that was read, with all that it draws with, upright and at the origin, and a content stream after it.

        Of fonts, those that the page has under the same name stay its own.
        """
        x0, y0, x1, y1 = page.box
        turn = {0: (1, 0, 0, 1, -x0, -y0), 90: (0, -1, 1, 0, -y0, x1), 180: (-1, 0, 0, -1, x1, y1), 270: (0, 1, -1, 0, y1, -x0)}[page.rotation]
        before = "q {:.4f} {:.4f} {:.4f} {:.4f} {:.4f} {:.4f} cm ".format(*turn) + f"{x0:.4f} {y0:.4f} {x1 - x0:.4f} {y1 - y0:.4f} re W n\n"
        own = {f: (page.document, x) for f, x in page.font_objects.items()}
        rest = {k: v for k, v in page.resources.items() if k != "Font"}
        resources = b"".join(b" " + spelt(Name(k), None) + b" " + self.copied(page.document, v) for k, v in rest.items())
        resources += self._fonts((*own, *(f for f in fonts if f not in own)), (objects or {}) | own)
        contents = [b"%d 0 R" % self._stream("", before.encode()), *(self.copied(page.document, s) for s in page.streams), b"%d 0 R" % self._stream("", b"\nQ\n")]
        self._finish(*page.rect[2:], resources, contents + ([b"%d 0 R" % self._stream("", text)] if text else []))

    def _add(self, body: bytes) -> int:
        self.bodies.append(body)
        return len(self.bodies)

    def _stream(self, entries: str, data: bytes, packed: bool = True) -> int:
        if packed:
            data, entries = zlib.compress(data), entries + " /Filter /FlateDecode"
        return self._add(f"<< {entries} /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream")

    def _image(self, data: bytes) -> int:
        if data[:2] == b"\xff\xd8":
            (w, h), n = jpeg.dimensions(data), jpeg.components(data)
            space = {1: "DeviceGray", 3: "DeviceRGB", 4: "DeviceCMYK"}[n]
            return self._stream(f"/Type /XObject /Subtype /Image /Width {w} /Height {h} /ColorSpace /{space} /BitsPerComponent 8 /Filter /DCTDecode", data, False)
        pixels = png.decode(data)
        pixels = pixels[:, :, :3] if pixels.ndim == 3 and pixels.shape[2] == 4 else pixels[:, :, 0] if pixels.ndim == 3 and pixels.shape[2] == 2 else pixels
        space = "DeviceGray" if pixels.ndim == 2 else "DeviceRGB"
        return self._stream(f"/Type /XObject /Subtype /Image /Width {pixels.shape[1]} /Height {pixels.shape[0]} /ColorSpace /{space} /BitsPerComponent 8", np.ascontiguousarray(pixels).tobytes())

    def page(self, width: float, height: float, image: bytes | None = None, text: bytes = b"", fonts: tuple[str, ...] = (), objects: dict[str, tuple[Document, object]] | None = None, place: tuple[float, float, float, float] | None = None) -> None:
        """A page with an image in its whole rectangle, keeping the image's proportions, and a content stream after it.

        With place (x, y, width, height) the image lies there and the page shows what falls on it. An image that
        several pages show is stored once.
        """
        draw, names = b"", b""
        if image is not None:
            if image not in self.images:
                self.images[image] = self._image(image)
            w, h = jpeg.dimensions(image) if image[:2] == b"\xff\xd8" else png.size(image)
            scale = min(width / w, height / h)
            x, y, w, h = place or ((width - w * scale) / 2, (height - h * scale) / 2, w * scale, h * scale)
            clip = f"0 0 {width:.4f} {height:.4f} re W n " if place else ""
            draw, names = f"q {clip}{w:.4f} 0 0 {h:.4f} {x:.4f} {y:.4f} cm /Im0 Do Q\n".encode(), b" /XObject << /Im0 %d 0 R >>" % self.images[image]
        names += self._fonts(fonts, objects or {})
        self._finish(width, height, names, [b"%d 0 R" % self._stream("", s) for s in (draw, text) if s])

    def data(self) -> bytes:
        if not self.kids:
            raise ValueError("a PDF file needs a page")
        self.bodies[0] = b"<< /Type /Catalog /Pages 2 0 R >>"
        kids = " ".join(f"{k} 0 R" for k in self.kids)
        self.bodies[1] = f"<< /Type /Pages /Count {len(self.kids)} /Kids [{kids}] >>".encode()
        out, places = bytearray(b"%PDF-1.4\n%\xe2\xe3\xcf\xd3\n"), []
        for i, body in enumerate(self.bodies, 1):
            places.append(len(out))
            out += f"{i} 0 obj\n".encode() + body + b"\nendobj\n"
        start = len(out)
        out += f"xref\n0 {len(places) + 1}\n0000000000 65535 f \n".encode() + b"".join(f"{p:010d} 00000 n \n".encode() for p in places)
        out += f"trailer\n<< /Size {len(places) + 1} /Root 1 0 R >>\nstartxref\n{start}\n%%EOF\n".encode()
        return bytes(out)


def from_images(images: list[bytes], dpi: float = 96.0) -> bytes:
    """One page per image, in the given order, at its own resolution or the given one. ValueError without images."""
    w = Writer()
    for data in images:
        if data[:2] == b"\xff\xd8":
            (width, height), own = jpeg.dimensions(data), None
        else:
            (width, height), own = png.size(data), png.dpi(data)
        w.page(width * 72 / (own or dpi), height * 72 / (own or dpi), data)
    return w.data()
