import pytest
from pyspark.sql import functions as F

from folioforge.functions import names
from folioforge.operators import assembly, batch, geometry, imageprep, inventory, textlayer
from folioforge.operators.selection import Selection, parse, select_pages


def column(spark, values, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(expr(F.col("v"))).collect()]


NAMES = {
    "_page_0001-gigapixel-text-shapes-4x.jpeg": ("page_0001.jpeg", "-gigapixel-text-shapes-4x"),
    "page_0001.jpg": ("page_0001.jpg", ""),
    "_a.jpg": ("a.jpg", ""),
    "_a-gigapixel-x-gigapixel-y-4x.png": ("a.png", "-gigapixel-x-gigapixel-y-4x"),
    "_a-gigapixel-1.5x.jpg": ("a-gigapixel-1.5x.jpg", ""),
    "__b-gigapixel-z.tif": ("_b.tif", "-gigapixel-z"),
    "_-gigapixel-q.JPG": (".JPG", "-gigapixel-q"),
    "_c-gigapixel-.jpg": ("c-gigapixel-.jpg", ""),
}


def test_names(spark):
    assert column(spark, list(NAMES), names.base_name) == [b for b, _ in NAMES.values()]
    assert column(spark, list(NAMES), names.tag) == [t for _, t in NAMES.values()]
    odd = [".hidden", "a..pdf", "x.PDF", "none", "a.b.c", "a.jpg\n"]
    assert column(spark, odd, names.extension) == ["", "pdf", "pdf", "", "c", "jpg\n"]
    assert column(spark, odd, names.stem) == [".hidden", "a.", "x", "none", "a.b", "a"]
    assert column(spark, ["a.jpg\n", "a.JPG", "a.djvu"], names.is_image) == [False, True, False]


@pytest.mark.parametrize(
    "files, want",
    [
        (["p1.jpg", "_p1-gigapixel-s-4x.jpg"], ("complete", 1, 1, False)),
        (["p1.jpg", "p2.jpg", "_p1-gigapixel-s-4x.jpg"], ("partial", 2, 1, False)),
        (["p1.jpg", "_p1-gigapixel-s-4x.jpeg"], ("none", 1, 1, False)),
        (["_p1-gigapixel-s-4x.jpg"], ("none", 0, 1, False)),
        (["p1.jpg", "i.djvu"], ("none", 1, 0, True)),
        (["p1.jpg", "i.DJVU"], ("none", 1, 0, False)),
        (["readme.txt"], ("none", 0, 0, False)),
    ],
)
def test_status(spark, files, want):
    r = inventory.inventory(spark.createDataFrame([("d", f) for f in files], "dir string, name string")).first()
    assert (r.status, r.original_count, r.processed_count, r.has_djvu) == want


def test_coverage_is_not_capped(spark):
    files = [f"p{i}.jpg" for i in range(2)] + ["_p0.jpg"] + [f"_q{i}.jpg" for i in range(3)]
    r = inventory.coverage(inventory.inventory(spark.createDataFrame([("d", f) for f in files], "dir string, name string"))).first()
    assert (r.status, r.coverage, r.suffix_text) == ("partial", "200%", "—")
    empty = spark.createDataFrame([], "dir string, name string")
    assert inventory.totals(inventory.inventory(empty)).first().none_percent == 0


def test_assembly_filter(spark):
    files = spark.createDataFrame([("d", n) for n in ("_p-4x.jpg", "_p-4x.JPEG", "p-4x.jpg", "_p-2x.jpg", "_p-4X.jpg", "_p-4x.png")], "dir string, name string")
    assert {r.name for r in assembly.assembly_filter(files).collect()} == {"_p-4x.jpg", "_p-4x.JPEG"}
    assert assembly.assembly_filter(files, prefixes=[]).count() == assembly.assembly_filter(files, suffixes=[]).count() == 0


def test_parse():
    assert parse("all") == parse(" ALL ") == Selection()
    assert parse("0, 2,5").pages == (0, 2, 5)
    assert parse(":5") == Selection("slice", (), None, 5) and parse("1:10:2") == Selection("slice", (), 1, 10, 2)
    for bad in ("1:2:3:4", "", "a"):
        with pytest.raises(ValueError):
            parse(bad)


def test_slices_follow_python(spark):
    pages = spark.createDataFrame([(f"d{n}", i) for n in (1, 2, 5, 7) for i in range(n)], "doc string, page_idx long").cache()
    parts = (None, -8, -3, -1, 0, 2, 6, 9)
    cases = [(a, b, k) for a in parts[::2] for b in parts for k in (1, -1, 2, -3)][::3]
    for a, b, k in cases:
        got = {}
        for r in select_pages(pages, Selection("slice", (), a, b, k)).orderBy("doc", "pos").collect():
            got.setdefault(r.doc, []).append(r.page_idx)
        for n in (1, 2, 5, 7):
            want = list(range(n))[a:b:k]
            assert got.get(f"d{n}", []) == (sorted(want) if sorted(want) == list(range(n)) else want)


def test_list_selection(spark):
    pages = spark.createDataFrame([("d", i) for i in range(3)], "doc string, page_idx long")
    run = lambda *p: [r.page_idx for r in select_pages(pages, Selection("list", p)).orderBy("pos").collect()]
    assert run(2, 0, 2) == [2, 0, 2] and run(2, 1, 0, 0) == [0, 1, 2] and run() == []
    with pytest.raises(Exception, match="selected page is missing"):
        run(0, 3)
    with pytest.raises(ValueError):
        select_pages(pages, Selection("slice", (), None, None, 0))


def test_boxes_tile_the_page(spark):
    pages = spark.createDataFrame([("d", 0, 0.0, 0.0, 288.0, 250.0), ("d", 1, 5.0, 1.0, 292.9, 251.0), ("d", 2, 0.0, 0.0, 10.0, 0.0)], "doc string, page_idx int, x0 double, y0 double, x1 double, y1 double")
    rows = geometry.numbered(geometry.page_boxes(pages)).orderBy("box_idx").collect()
    assert [(r.page_idx, r.half, r.bx0, r.bx1) for r in rows] == [(0, 0, 0.0, 144.0), (0, 1, 144.0, 288.0), (1, 0, 5.0, 292.9), (2, 0, 0.0, 10.0)]
    assert [r.f for r in geometry.page_boxes(pages).orderBy("page_idx", "half").select(geometry.full_page().alias("f")).collect()] == [False, False, True, True]


def test_skew(spark):
    angles = [None, float("nan"), 0.05, 0.1, 0.11, -39.9, 40.0, 41.0]
    assert column(spark, angles, imageprep.applied_skew, "double") == [0, 0, 0, 0, 0.11, -39.9, 40.0, 0]


def test_text_layer(spark):
    data = [(["q /OCR-1 Do Q", "plain", "/OCR-2 Do"], {"OCR-a": "x", "Im": "y"}), ([], {})]
    df = spark.createDataFrame(data, "s array<string>, o map<string,string>")
    assert [r[0] for r in df.select(textlayer.page_text(F.col("s"), F.transform_keys("o", lambda k, v: F.concat(F.lit("/"), k)))).collect()] == ["x\nx", ""]
    assert column(spark, ["a\n/Im0 Do\nb\r\n", "", "/Im0\nDo"], textlayer.without_image_lines) == ["a\nb\r\n", "", "/Im0\nDo"]
    every = bytes(range(256))
    one = spark.createDataFrame([(bytearray(every),)], "b binary")
    assert bytes(one.select(textlayer.encoded(textlayer.decoded(F.col("b")))).first()[0]) == every


def test_page_merge_keeps_surplus_source_pages(spark):
    src = spark.createDataFrame([("d", 0), ("d", 1)], "doc string, page_idx int")
    layer = spark.createDataFrame([("d", 0, "t"), ("d", 5, "lost")], "doc string, page_idx int, text string")
    assert sorted((r.page_idx, r.layer_text) for r in textlayer.merge_pages(src, layer).collect()) == [(0, "t"), (1, None)]


def test_fonts(spark):
    src = spark.createDataFrame([(1, "A", "own")], "page int, font string, value string")
    layer = spark.createDataFrame([(1, "A", "x", 0), (1, "B", "old", 1), (1, "B", "new", 2)], "page int, font string, value string, n int")
    assert sorted((r.font, r.value, r.copied) for r in textlayer.merge_fonts(src, layer, "page", "n").collect()) == [("A", "own", False), ("B", "new", True)]


def test_results(spark):
    r = spark.createDataFrame([("a/x", "x", "bad"), ("b/x", "x", None), ("y", "y", "bad")], "rel_path string, file_name string, error string")
    assert {x.file_name: x.error for x in batch.by_name(r).collect()} == {"x": None, "y": "bad"}
    assert tuple(batch.summary(r).first()) == (3, 1, 2)


def test_run_tasks_keeps_errors_as_values(spark):
    todo = spark.createDataFrame([("a/x.pdf",), ("b.pdf",)], "rel_path string")

    def work(row):
        if row["rel_path"] == "b.pdf":
            raise ValueError("no")

    assert {r.rel_path: (r.file_name, r.error) for r in batch.run_tasks(todo, work).collect()} == {"a/x.pdf": ("x.pdf", None), "b.pdf": ("b.pdf", "no")}


def test_paths(spark):
    files = spark.createDataFrame([("/s/a/b.v2.pdf", "a/b.v2.pdf")], "path string, rel_path string")
    r = batch.tasks(files, "/out/", save_pictures=True).first()
    assert (r.target, r.pictures) == ("/out/a/b.v2.pdf", "/out/a/b.v2.page_pics")
    assert batch.tasks(files, "/out").first().pictures is None
    assert sorted(["a-1/c", "a/b"], key=lambda p: p.split("/")) == [x.p for x in spark.createDataFrame([("a-1/c",), ("a/b",)], "p string").orderBy(names.path_order(F.col("p"))).collect()]


def test_picture_names_are_never_cut(spark):
    boxes = spark.createDataFrame([(0,), (999,), (9999,), (10000,), (123456,)], "box long")
    got = [r[0] for r in boxes.select(names.picture_name(F.col("box"), F.lit("jpg"))).collect()]
    assert got == [f"page_{i:04d}.jpg" for i in (0, 999, 9999, 10000, 123456)]
