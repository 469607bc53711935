"""Named queries over the driver's tables and the DuckDB SQL of those that SQL expresses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.codecs import jpeg, pdf, png
from folioforge.functions import names
from folioforge.operators import assembly, batch, geometry, imageprep, inventory, selection, textlayer
from folioforge.plans.bindings import BOXES_SQL, LISTING_SQL, PAGES_SQL, TURNS_SQL, listing, pages, table, turns

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


# Listings and inventories

NAMED_SQL = (
    LISTING_SQL
    + r""",
    named as (
        select dir, name, name like '%.djvu' as djvu, regexp_matches(lower(name), '\.(jpg|jpeg|png|tif|tiff)$') as image, name[1] = '_' as processed,
               case when name[1] = '_' then regexp_replace(substr(name, 2), '-gigapixel-[^.]+(\.[^.]+)$', '\1') else name end as base,
               case when name[1] = '_' then regexp_extract(name, '(-gigapixel-[^.]+)\.[^.]+$', 1) else '' end as tag
        from files)"""
)
INVENTORY_SQL = (
    NAMED_SQL
    + """,
    orig as (select distinct dir, base from named where image and not processed),
    proc as (select distinct dir, base from named where image and processed),
    counts as (
        select f.dir as path, f.has_djvu, coalesce(o.n, 0) as original_count, coalesce(p.n, 0) as processed_count, coalesce(m.n, 0) as matched, coalesce(s.list, []) as tags
        from (select dir, bool_or(djvu) as has_djvu from named group by dir) f
        left join (select dir, count(*) as n from orig group by dir) o using (dir)
        left join (select dir, count(*) as n from proc group by dir) p using (dir)
        left join (select dir, count(*) as n from orig semi join proc using (dir, base) group by dir) m using (dir)
        left join (select dir, list_sort(list(distinct tag)) as list from named where image and tag <> '' group by dir) s using (dir)),
    inv as (
        select path, has_djvu, case when original_count = 0 or matched = 0 then 'none' when matched = original_count then 'complete' else 'partial' end as status,
               original_count, processed_count, tags from counts)"""
)
COVERAGE = "case when status = 'partial' then cast(processed_count * 100 // original_count as varchar) || '%' else '—' end"


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory(listing(spark, sf_dir))


def _flat(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    return df.withColumn(column, F.array_join(column, sep))


@query(f"with {INVENTORY_SQL} select path, has_djvu, status, original_count, processed_count, array_to_string(tags, ',') as suffixes from inv")
def issue_processing_status(spark, sf_dir):
    return _flat(_inventory(spark, sf_dir), "suffixes")


@query(f"with {NAMED_SQL} select name, base from named")
def base_filename(spark, sf_dir):
    return listing(spark, sf_dir).select("name", names.base_name(F.col("name")).alias("base"))


@query(f"with {NAMED_SQL} select name, tag from named")
def processing_suffix(spark, sf_dir):
    return listing(spark, sf_dir).select("name", names.tag(F.col("name")).alias("tag"))


@query(f"with {NAMED_SQL} select dir, base, array_to_string(list_sort(list(tag)), '|') as tags from named where image and processed group by dir, base")
def processed_multimap(spark, sf_dir):
    return _flat(inventory.processed_multimap(listing(spark, sf_dir)), "tags", "|")


@query(f"with {INVENTORY_SQL} select dir, base from orig semi join proc using (dir, base)")
def matched_originals(spark, sf_dir):
    return inventory.matched_originals(listing(spark, sf_dir))


@query(f"with {INVENTORY_SQL} select dir, base from proc anti join orig using (dir, base)")
def orphan_processed(spark, sf_dir):
    return inventory.orphans(listing(spark, sf_dir))


@query(
    f"""with {INVENTORY_SQL},
    t as (select count(*) as directories, count(*) filter (where has_djvu) as with_djvu, count(*) filter (where status = 'complete') as complete,
                 count(*) filter (where status = 'partial') as partial, count(*) filter (where status = 'none') as none from inv)
    select *, {", ".join(f"case when directories = 0 then 0 else {c} * 100 // directories end as {c}_percent" for c in ("with_djvu", "complete", "partial", "none"))} from t"""
)
def inventory_totals(spark, sf_dir):
    return inventory.totals(_inventory(spark, sf_dir))


@query(
    f"""with {INVENTORY_SQL}
    select 'unprocessed_without_djvu' as category, path, status, has_djvu from inv where status = 'none' and not has_djvu
    union all select 'partial', path, status, has_djvu from inv where status = 'partial'
    union all select 'with_djvu', path, status, has_djvu from inv where has_djvu
    union all select 'complete_without_djvu', path, status, has_djvu from inv where status = 'complete' and not has_djvu"""
)
def report_categories(spark, sf_dir):
    return inventory.categorised(_inventory(spark, sf_dir)).select("category", "path", "status", "has_djvu")


@query(
    f"""with {INVENTORY_SQL}
    select count(*) filter (where status = 'none' and not has_djvu) as unprocessed_without_djvu, count(*) filter (where status = 'partial') as partial,
           count(*) filter (where has_djvu) as with_djvu, count(*) filter (where status = 'complete' and not has_djvu) as complete_without_djvu from inv"""
)
def category_counts(spark, sf_dir):
    own = inventory.categorised(_inventory(spark, sf_dir))
    return own.agg(*[F.count_if(F.col("category") == c).alias(c) for c in inventory.CATEGORIES])


@query(
    f"""with {INVENTORY_SQL} select path, status, {COVERAGE} as coverage,
        case when len(tags) = 0 then '—' else array_to_string(list_transform(tags, lambda x: '`' || x || '`'), ', ') end as suffix_text from inv"""
)
def partial_coverage(spark, sf_dir):
    return inventory.coverage(_inventory(spark, sf_dir)).select("path", "status", "coverage", "suffix_text")


@query(f"with {INVENTORY_SQL} select suffix, count(*) as directories from (select unnest(tags) as suffix from inv) group by suffix")
def suffix_usage(spark, sf_dir):
    return inventory.suffix_usage(_inventory(spark, sf_dir))


CHOSEN = r"regexp_matches(lower(name), '.\.(jpg|jpeg)$') and name[1] = '_' and regexp_replace(name, '(.)\.[^.]+$', '\1') like '%-4x'"


@query(f"with {LISTING_SQL} select dir, name from files where {CHOSEN}")
def image_assembly_filter(spark, sf_dir):
    return assembly.assembly_filter(listing(spark, sf_dir))


@query(f"with {LISTING_SQL} select dir, dir || '.pdf' as pdf_name, count(*) as n_images, string_agg(name, '|' order by name) as images from files where {CHOSEN} group by dir")
def assembly_manifest(spark, sf_dir):
    own = assembly.manifest(assembly.assembly_filter(listing(spark, sf_dir)))
    return own.select("dir", "pdf_name", F.size("images").cast("long").alias("n_images"), F.array_join("images", "|").alias("images"))


@query("select doc_id, cast(doc_id as varchar) || '.pdf' as pdf_name from documents where doc_id not in (select doc_id from labels where quality = 0 or toxic = 1)")
def skip_existing(spark, sf_dir):
    pdf = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf_name")
    done = table(spark, sf_dir, "labels").where("quality = 0 or toxic = 1").select(pdf)
    return assembly.todo(table(spark, sf_dir, "documents").select("doc_id", pdf), done)


# Page geometry


@query(f"with {PAGES_SQL} select doc, page_idx, x1 / y1 as aspect from pages")
def page_aspect(spark, sf_dir):
    return pages(spark, sf_dir).select("doc", "page_idx", geometry.aspect(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("aspect"))


@query(f"with {PAGES_SQL} select doc, page_idx from pages where x1 / y1 >= 1.152::double")
def spread_filter(spark, sf_dir):
    return pages(spark, sf_dir).where(geometry.is_spread(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).select("doc", "page_idx")


@query(f"with {BOXES_SQL} select doc, page_idx, half, bx0, by0, bx1, by1, bx1 - bx0 as width, by1 - by0 as height from boxes")
def page_boxes(spark, sf_dir):
    own = geometry.page_boxes(pages(spark, sf_dir))
    return own.select("doc", "page_idx", "half", "bx0", "by0", "bx1", "by1", (F.col("bx1") - F.col("bx0")).alias("width"), (F.col("by1") - F.col("by0")).alias("height"))


@query(f"with {BOXES_SQL} select doc, page_idx, half, row_number() over (partition by doc order by page_idx, half) - 1 as box_idx from boxes")
def box_ordinals(spark, sf_dir):
    return geometry.numbered(geometry.page_boxes(pages(spark, sf_dir))).select("doc", "page_idx", "half", F.col("box_idx").cast("long"))


#: Made-up images: 300 DPI, and for crop_min_size some that leave hardly a pixel.
IMAGE_SQL = "cast(trunc(x1 * 2.5) as int) as img_width, 2105 as img_height"
CROPS_SQL = (
    BOXES_SQL
    + """,
    px as (
        select *, cast(trunc((bx0 - x0) * (img_width / (x1 - x0))) as int) as crop_x, cast(trunc((by0 - y0) * (img_height / (y1 - y0))) as int) as crop_y,
               cast(trunc((bx1 - x0) * (img_width / (x1 - x0))) as int) as r, cast(trunc((by1 - y0) * (img_height / (y1 - y0))) as int) as d
        from (select *, IMAGE from boxes)),
    crops as (select *, r - crop_x as crop_w, d - crop_y as crop_h from px)"""
)


def _crops(spark, sf_dir, width: Column, height: Column) -> DataFrame:
    own = geometry.page_boxes(pages(spark, sf_dir)).withColumns({"img_width": width.cast("int"), "img_height": height.cast("int")})
    return geometry.crop_pixels(own)


@query(
    f"""with {CROPS_SQL.replace("IMAGE", IMAGE_SQL)} select doc, page_idx, half, crop_x, crop_y, crop_w, crop_h,
    crop_w || 'x' || crop_h || '+' || crop_x || '+' || crop_y as crop_spec from crops"""
)
def crop_pixels(spark, sf_dir):
    own = _crops(spark, sf_dir, F.col("x1") * 2.5, F.lit(2105))
    return own.select("doc", "page_idx", "half", "crop_x", "crop_y", "crop_w", "crop_h", "crop_spec")


@query(
    f"""with {CROPS_SQL.replace("IMAGE", "p_size % 25 as img_width, p_size as img_height")} select doc, page_idx, half, crop_w < 10 or crop_h < 10 as blank,
    case when crop_w < 10 or crop_h < 10 then greatest(crop_w, 10) else crop_w end as out_w, case when crop_w < 10 or crop_h < 10 then greatest(crop_h, 10) else crop_h end as out_h from crops"""
)
def crop_min_size(spark, sf_dir):
    own = geometry.crop_or_blank(_crops(spark, sf_dir, F.col("p_size") % 25, F.col("p_size")))
    return own.select("doc", "page_idx", "half", "blank", "out_w", "out_h")


@query(f"with {BOXES_SQL} select doc, page_idx, half, abs(bx0 - x0) < 1 and abs(by0 - y0) < 1 and abs(bx1 - x1) < 1 and abs(by1 - y1) < 1 as full_page from boxes")
def full_page_flag(spark, sf_dir):
    return geometry.page_boxes(pages(spark, sf_dir)).select("doc", "page_idx", "half", geometry.full_page().alias("full_page"))


def _selected(spark, sf_dir, spec: str) -> DataFrame:
    return selection.select_pages(pages(spark, sf_dir), selection.parse(spec)).select("doc", "page_idx", "pos")


@query(f"with {PAGES_SQL} select doc, page_idx, pos from pages join (values (0, 2), (1, 0), (2, 2), (3, 3)) as s(pos, page_idx) using (page_idx)".replace("select doc, page_idx, pos", "select doc, page_idx, cast(pos as bigint) as pos"))
def select_pages_list(spark, sf_dir):
    return _selected(spark, sf_dir, "2,0,2,3")


@query(f"with {PAGES_SQL} select doc, page_idx, (page_idx - 1) // 2 as pos from pages where page_idx >= 1 and page_idx < 10 and (page_idx - 1) % 2 = 0")
def select_pages_slice(spark, sf_dir):
    return _selected(spark, sf_dir, "1:10:2")


@query(
    f"""with {PAGES_SQL}, n as (select *, count(*) over (partition by doc) as n from pages)
    select doc, page_idx, (greatest(n - 5, -1) - page_idx) // 3 as pos from n
    where page_idx <= greatest(n - 5, -1) and page_idx > greatest(n - 20, -1) and (greatest(n - 5, -1) - page_idx) % 3 = 0"""
)
def select_pages_reverse(spark, sf_dir):
    return _selected(spark, sf_dir, "-5:-20:-3")


@query(f"with {PAGES_SQL} select doc, page_idx, page_idx as pos from pages")
def select_pages_full_cover(spark, sf_dir):
    return _selected(spark, sf_dir, "::-1")


@query(
    """select spec, kind, pages, cast(start as varchar) as start, cast(stop as varchar) as stop, cast(step as varchar) as step from (values
    ('all', 'all', null, null, null, null), (' ALL ', 'all', null, null, null, null), ('0,2,5', 'list', '0,2,5', null, null, null),
    ('0, 2, 5', 'list', '0,2,5', null, null, null), ('3', 'list', '3', null, null, null), ('1:10', 'slice', null, 1, 10, null),
    ('1:10:2', 'slice', null, 1, 10, 2), (':5', 'slice', null, null, 5, null), ('3:', 'slice', null, 3, null, null), ('::-1', 'slice', null, null, null, -1),
    ('1:2:3:4', 'error', null, null, null, null), ('', 'error', null, null, null, null), ('a', 'error', null, null, null, null))
    as t(spec, kind, pages, start, stop, step)"""
)
def page_spec_parse(spark, sf_dir):
    specs = ["all", " ALL ", "0,2,5", "0, 2, 5", "3", "1:10", "1:10:2", ":5", "3:", "::-1", "1:2:3:4", "", "a"]
    own = spark.createDataFrame([(s,) for s in specs], "spec string").select("spec", selection.parsed(F.col("spec")).alias("p"))
    return own.select("spec", "p.kind", "p.pages", *[F.col(f"p.{c}").cast("string").alias(c) for c in ("start", "stop", "step")])


# Image preparation

DPI_SQL = "(img_width / (x1 / 72) + img_height / (y1 / 72)) / 2"


@query(f"with {PAGES_SQL} select doc, page_idx, {DPI_SQL} as dpi, cast(trunc({DPI_SQL} * 2.0::double) as int) as new_dpi from (select *, {IMAGE_SQL} from pages)")
def page_dpi(spark, sf_dir):
    own = pages(spark, sf_dir).withColumns({"w": (F.col("x1") * 2.5).cast("int"), "h": F.lit(2105)})
    dpi = imageprep.page_dpi(F.col("w"), F.col("h"), F.col("x1"), F.col("y1"))
    return own.select("doc", "page_idx", dpi.alias("dpi"), imageprep.new_dpi(dpi, F.lit(2.0)).alias("new_dpi"))


@query(
    f"""with {PAGES_SQL}, u as (select doc, page_idx, cast(trunc(img_width * 1.7::double) as int) as new_w, cast(trunc(img_height * 1.7::double) as int) as new_h,
    cast(trunc({DPI_SQL} * 1.7::double) as int) as dpi from (select *, {IMAGE_SQL} from pages))
    select doc, page_idx, new_w, new_h, new_w * 72 / dpi::double as page_w, new_h * 72 / dpi::double as page_h from u"""
)
def upscaled_page_size(spark, sf_dir):
    own = pages(spark, sf_dir).withColumns({"w": (F.col("x1") * 2.5).cast("int"), "h": F.lit(2105)})
    ratio = F.lit(1.7)
    dpi = imageprep.new_dpi(imageprep.page_dpi(F.col("w"), F.col("h"), F.col("x1"), F.col("y1")), ratio)
    new_w, new_h = imageprep.upscaled(F.col("w"), ratio), imageprep.upscaled(F.col("h"), ratio)
    return own.select("doc", "page_idx", new_w.alias("new_w"), new_h.alias("new_h"), imageprep.page_points(new_w, dpi).alias("page_w"), imageprep.page_points(new_h, dpi).alias("page_h"))


ANGLE_SQL = "case when p_size % 7 = 0 then null else (p_size - 25) / 10.0::double * (p_size % 20) end"
SKEW_SQL = f"case when abs({ANGLE_SQL}) <= 40 and abs({ANGLE_SQL}) > 0.1::double then {ANGLE_SQL} else 0.0::double end"


def _angle() -> Column:
    return F.when(F.col("p_size") % 7 != 0, (F.col("p_size") - 25) / F.lit(10.0) * (F.col("p_size") % 20))


@query(f"select p_partkey, {SKEW_SQL} as angle from part")
def skew_clamp(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", imageprep.applied_skew(_angle()).alias("angle"))


@query(f"select p_partkey, abs({SKEW_SQL}) > 0.1::double or abs(ratio - 1) > 0.01::double as transform from (select *, 1 + (p_size % 3) / 100.0::double as ratio from part)")
def transform_needed(spark, sf_dir):
    ratio = F.lit(1) + (F.col("p_size") % 3) / F.lit(100.0)
    return table(spark, sf_dir, "part").select("p_partkey", imageprep.needs_transform(imageprep.applied_skew(_angle()), ratio).alias("transform"))


# Text layers


@query(
    """select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: not (contains(x, 'the') and contains(x, 'on'))), chr(10)) as kept from documents where text is not null
    union all select doc_id, null from documents where text is null"""
)
def ocr_line_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", textlayer.without_image_lines(F.col("text"), "the", "on").alias("kept"))


@query("select doc_id, contains(text, 'The') and contains(text, 'ing') as draws from documents")
def ocr_stream_gate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", textlayer.draws_object(F.col("text"), "The", "ing").alias("draws"))


@query(f"with {TURNS_SQL} select doc, page_idx, src.text || case when coalesce(layer.text, '') = '' then '' else chr(10) || layer.text end as merged from src left join layer using (doc, page_idx)")
def text_layer_merge(spark, sf_dir):
    both = textlayer.merge_pages(turns(spark, sf_dir, "user"), turns(spark, sf_dir, "assistant"))
    return both.select("doc", "page_idx", F.array_join(textlayer.appended(F.array("text"), F.col("layer_text")), "\n").alias("merged"))


@query(
    f"""with {TURNS_SQL}, a as (select doc, count(*) as n from src group by doc), b as (select doc, count(*) as n from layer group by doc)
    select doc, coalesce(a.n, 0) as source_pages, coalesce(b.n, 0) as layer_pages, least(coalesce(a.n, 0), coalesce(b.n, 0)) as merged_pages
    from a full join b using (doc) where coalesce(a.n, 0) <> coalesce(b.n, 0)"""
)
def page_count_mismatch(spark, sf_dir):
    return textlayer.page_count_mismatch(turns(spark, sf_dir, "user"), turns(spark, sf_dir, "assistant"))


@query(
    """with own as (select user_id as page, event_type as font, max_by(value, event_id) as value from events where event_id % 3 = 0 group by all),
    l as (select user_id as page, event_type as font, max_by(value, event_id) as value from events where event_id % 3 <> 0 group by all)
    select page, font, value, false as copied from own union all select page, font, value, true from l anti join own using (page, font)"""
)
def font_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("font"), "value", "event_id")
    own = e.where("event_id % 3 = 0").groupBy("page", "font").agg(F.max_by("value", "event_id").alias("value"))
    return textlayer.merge_fonts(own, e.where("event_id % 3 != 0"), "page", "event_id")


@query("select page_id, lower(hex(encode(url))) as bytes, true as same from pages where url is not null")
def latin1_round_trip(spark, sf_dir):
    data = F.encode(F.col("url"), "ISO-8859-1")
    own = table(spark, sf_dir, "pages").where("url is not null")
    return own.select("page_id", F.lower(F.hex(data)).alias("bytes"), (textlayer.encoded(textlayer.decoded(data)) == data).alias("same"))


# Batches and paths


@query("select doc_id, 'out/' || source || '/' || lang || '/' || doc_id || '.v2.pdf' as target from documents")
def output_path_map(spark, sf_dir):
    rel = names.joined(F.col("source"), F.col("lang"), F.concat(F.col("doc_id").cast("string"), F.lit(".v2.pdf")))
    return table(spark, sf_dir, "documents").select("doc_id", names.joined("out", rel).alias("target"))


@query("select doc_id, case when doc_id % 2 = 0 then 'out/' || source || '/' || doc_id || '.v2.page_pics' end as pictures from documents")
def page_pics_path(spark, sf_dir):
    rel = names.joined(F.col("source"), F.concat(F.col("doc_id").cast("string"), F.lit(".v2.pdf")))
    return table(spark, sf_dir, "documents").select("doc_id", names.pictures_dir(rel, "out", F.col("doc_id") % 2 == 0).alias("pictures"))


@query(f"with {BOXES_SQL}, n as (select *, row_number() over (partition by doc order by page_idx, half) - 1 as box_idx from boxes) select doc, box_idx, 'page_' || lpad(cast(box_idx as varchar), 4, '0') || '.jpg' as picture from n")
def page_picture_name(spark, sf_dir):
    own = geometry.numbered(geometry.page_boxes(pages(spark, sf_dir)))
    return own.select("doc", F.col("box_idx").cast("long").alias("box_idx"), names.picture_name(F.col("box_idx"), F.lit("jpg")).alias("picture"))


def _results(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("n"))
    error = F.when(F.col("n") < 500, F.concat(F.lit("too short: "), F.col("n").cast("string")))
    name = F.concat(F.lit("f"), (F.col("doc_id") % 50).cast("string"), F.lit(".pdf"))
    return d.select(names.joined(F.col("source"), name).alias("rel_path"), name.alias("file_name"), error.alias("error"), F.col("doc_id").alias("task"))


RESULTS_SQL = "r as (select 'f' || doc_id % 50 || '.pdf' as file_name, case when len(text) < 500 then 'too short: ' || len(text) end as error, doc_id as task from documents)"


@query(f"with {RESULTS_SQL} select file_name, error from (select *, row_number() over (partition by file_name order by task desc) as n from r) where n = 1")
def batch_results(spark, sf_dir):
    return batch.by_name(_results(spark, sf_dir), "task")


@query(f"with {RESULTS_SQL} select count(*) as total, count(*) filter (where error is null) as ok, count(error) as failed from r")
def batch_summary(spark, sf_dir):
    return batch.summary(_results(spark, sf_dir))


# Codecs, on bytes made up from parts


@query("select p_partkey, 100 + p_size * 17 as width, 50 + p_size as height, cast(null as varchar) as error from part")
def jpeg_dimensions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    w, h = (100 + F.col("p_size") * 17).cast("int"), (50 + F.col("p_size")).cast("int")
    data = F.unhex(F.concat(F.lit("FFD8FFE000040000FFC4000400FFFFC0001108"), F.lpad(F.hex(h), 4, "0"), F.lpad(F.hex(w), 4, "0"), F.lit("03011100021100031100")))
    return p.select("p_partkey", jpeg.dimensions_column(data).alias("d")).select("p_partkey", "d.*").withColumns({c: F.col(c).cast("int") for c in ("width", "height")})


@query("select p_size, greatest(p_size, 10) as width, greatest(p_size % 7, 10) as height, 3 * greatest(p_size, 10) * greatest(p_size % 7, 10) * 255 as total from part group by p_size")
def png_blank(spark, sf_dir):
    def run(frames):
        for frame in frames:
            made = [png.blank(max(n, 10), max(n % 7, 10)) for n in frame["p_size"]]
            yield frame.assign(width=[png.size(d)[0] for d in made], height=[png.size(d)[1] for d in made], total=[int(png.decode(d).sum(dtype=int)) for d in made])

    return table(spark, sf_dir, "part").select("p_size").distinct().mapInPandas(run, "p_size int, width int, height int, total int")


@query(f"with {PAGES_SQL} select doc, count(*) as n, sum(x1) as width, 24 * 16 * count(*) as pixels from pages group by doc")
def pdf_roundtrip(spark, sf_dir):
    def run(frame):
        w = pdf.Writer()
        for width in frame.sort_values("page_idx")["x1"]:
            w.page(width, 842.0, png.blank(24, 16))
        own = pdf.read(w.data())
        return pd.DataFrame([(frame["doc"].iloc[0], len(own), sum(p.rect[2] for p in own), sum(i.width * i.height for p in own for i in p.images))], columns=["doc", "n", "width", "pixels"])

    return pages(spark, sf_dir).select("doc", "page_idx", "x1").groupBy("doc").applyInPandas(run, "doc string, n long, width double, pixels long")
