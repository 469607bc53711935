"""The operators' inputs derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.selection import page_numbers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dir, name: original, processed and DjVu files made up from documents and labels, one scan of each."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("has", F.lit(True))
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dir"), "lang").join(labelled, "doc_id", "left")
    number, k = F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.col("doc_id") % 20
    suffix = F.when(F.col("doc_id") % 3 == 0, "-gigapixel-standard-4x").when(F.col("doc_id") % 7 == 0, "").otherwise("-gigapixel-text-shapes-4x")
    made = k.isin(1, 6) | (~k.isin(0, 5, 10) & F.coalesce("has", F.lit(False)))
    files = F.array(
        F.concat(F.lit("page_"), number, F.lit(".jpg")),
        F.when(made, F.concat(F.lit("_page_"), number, suffix, F.lit(".jpg"))),
        F.when(k == 2, F.concat(F.lit("_page_"), number, F.lit("-gigapixel-text-shapes-4x.jpeg"))),
        F.when(k.isin(1, 5, 7, 8) & (F.col("lang") == "en"), F.concat(F.lit("issue_"), number, F.lit(".djvu"))),
    )
    return d.select("dir", F.explode(F.filter(files, lambda x: x.isNotNull())).alias("name"))


LISTING_SQL = """
    d as (select doc_id, source as dir, lang, lpad(cast(doc_id as varchar), 6, '0') as id, doc_id % 20 as k,
                 doc_id in (select doc_id from labels) as has from documents),
    files as (
        select dir, 'page_' || id || '.jpg' as name from d
        union all select dir, '_page_' || id || case when doc_id % 3 = 0 then '-gigapixel-standard-4x' when doc_id % 7 = 0 then ''
                                                   else '-gigapixel-text-shapes-4x' end || '.jpg'
            from d where k in (1, 6) or (k not in (0, 5, 10) and has)
        union all select dir, '_page_' || id || '-gigapixel-text-shapes-4x.jpeg' from d where k = 2
        union all select dir, 'issue_' || id || '.djvu' from d where k in (1, 5, 7, 8) and lang = 'en')"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, page_idx, x0..y1 of pages made up from parts: one document per brand, widths by size."""
    p = page_numbers(table(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), "p_partkey", "p_size"), "doc", "p_partkey")
    zero = F.lit(0.0)
    return p.select("doc", "page_idx", "p_size", zero.alias("x0"), zero.alias("y0"), (400.0 + 17.0 * F.col("p_size")).alias("x1"), F.lit(842.0).alias("y1"))


PAGES_SQL = """
    pages as (select p_brand as doc, row_number() over (partition by p_brand order by p_partkey) - 1 as page_idx, p_size,
                     0.0::double as x0, 0.0::double as y0, 400.0::double + 17.0::double * p_size as x1, 842.0::double as y1 from part)"""

BOXES_SQL = (
    PAGES_SQL
    + """,
    boxes as (
        select *, 0 as half, x0 as bx0, y0 as by0, case when x1 / y1 >= 1.152::double then x0 + (x1 - x0) / 2 else x1 end as bx1, y1 as by1 from pages
        union all select *, 1, x0 + (x1 - x0) / 2, y0, x1, y1 from pages where x1 / y1 >= 1.152::double)"""
)


def turns(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """doc, page_idx, text: a conversation's turns of one role as pages."""
    t = table(spark, sf_dir, "conversations").where(F.col("role") == role).select(F.col("conv_id").alias("doc"), "turn", "text")
    return page_numbers(t, "doc", "turn").select("doc", "page_idx", "text")


TURNS_SQL = """
    src as (select conv_id as doc, row_number() over (partition by conv_id order by turn) - 1 as page_idx, text from conversations where role = 'user'),
    layer as (select conv_id as doc, row_number() over (partition by conv_id order by turn) - 1 as page_idx, text from conversations where role = 'assistant')"""
