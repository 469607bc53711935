"""Processing-status inventory of directories, and the frames of its report.

Input is a listing: one row per file with dir and name. Every figure of a directory comes from one aggregate over
(dir, base) groups, so the listing is shuffled once and pre-aggregated; originals meet processed images in the
same group instead of in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import names

#: A missing value in a report.
NOTHING = "—"
CATEGORIES = ("unprocessed_without_djvu", "partial", "with_djvu", "complete_without_djvu")


def images(files: DataFrame) -> DataFrame:
    """Image rows with base, tag and processed; DjVu files and others left out."""
    n = F.col("name")
    own = files.where(names.is_image(n) & ~names.is_djvu(n))
    return own.withColumns({"base": names.base_name(n), "tag": names.tag(n), "processed": names.is_processed(n)})


def processed_multimap(files: DataFrame) -> DataFrame:
    """dir, base, tags (sorted, with empties and repeats) of every processed image's base name."""
    return images(files).where("processed").groupBy("dir", "base").agg(F.sort_array(F.collect_list("tag")).alias("tags"))


def matched_originals(files: DataFrame) -> DataFrame:
    """Originals with a processed image of exactly their name, extension and case included."""
    own = images(files)
    return own.where("not processed").select("dir", "base").distinct().join(own.where("processed").select("dir", "base").distinct(), ["dir", "base"], "left_semi")


def orphans(files: DataFrame) -> DataFrame:
    """Base names of processed images whose original is absent."""
    own = images(files)
    return own.where("processed").select("dir", "base").distinct().join(own.where("not processed").select("dir", "base").distinct(), ["dir", "base"], "left_anti")


def status(originals: Column, matched: Column) -> Column:
    return F.when((originals == 0) | (matched == 0), "none").when(matched == originals, "complete").otherwise("partial")


def inventory(files: DataFrame) -> DataFrame:
    """path, has_djvu, status, original_count, processed_count, suffixes (sorted array) of every directory.

    processed_count counts base names of processed images, those without an original included, so it can exceed
    original_count. A directory without originals is `none`, whatever was processed.
    """
    n = F.col("name")
    own = files.withColumns({"djvu": names.is_djvu(n), "image": names.is_image(n)})
    own = own.withColumns({"base": F.when(F.col("image"), names.base_name(n)), "tag": F.when(F.col("image"), names.tag(n)), "processed": F.col("image") & names.is_processed(n)})
    by_base = own.groupBy("dir", "base").agg(
        F.bool_or("djvu").alias("djvu"),
        F.bool_or(F.col("image") & ~F.col("processed")).alias("original"),
        F.bool_or("processed").alias("processed"),
        F.collect_set(F.when(F.col("tag") != "", F.col("tag"))).alias("tags"),
    )
    by_dir = by_base.groupBy(F.col("dir").alias("path")).agg(
        F.bool_or("djvu").alias("has_djvu"),
        F.count_if("original").alias("original_count"),
        F.count_if("processed").alias("processed_count"),
        F.count_if(F.col("original") & F.col("processed")).alias("matched"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))).alias("suffixes"),
    )
    return by_dir.select("path", "has_djvu", status(F.col("original_count"), F.col("matched")).alias("status"), "original_count", "processed_count", "suffixes")


def share(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down; 0 of nothing."""
    return F.when(whole == 0, F.lit(0).cast("long")).otherwise(F.floor(F.try_divide(part * 100, whole)).cast("long"))


def totals(inventory: DataFrame) -> DataFrame:
    """One row: directories, with_djvu, complete, partial, none, and the last four's shares."""
    is_ = lambda s: F.count_if(F.col("status") == s).alias(s)
    one = inventory.agg(F.count("*").alias("directories"), F.count_if("has_djvu").alias("with_djvu"), is_("complete"), is_("partial"), is_("none"))
    return one.withColumns({f"{c}_percent": share(F.col(c), F.col("directories")) for c in ("with_djvu", "complete", "partial", "none")})


def categorised(inventory: DataFrame) -> DataFrame:
    """A row per directory and report category; the categories overlap, so one directory can have two rows."""
    s, djvu = F.col("status"), F.col("has_djvu")
    tests = [(s == "none") & ~djvu, s == "partial", djvu, (s == "complete") & ~djvu]
    found = F.filter(F.array(*[F.when(t, F.lit(c)) for c, t in zip(CATEGORIES, tests)]), lambda c: c.isNotNull())
    return inventory.withColumn("category", F.explode(found))


def coverage(inventory: DataFrame) -> DataFrame:
    """The inventory with the report's coverage and suffixes texts."""
    percent = F.concat(share(F.col("processed_count"), F.col("original_count")).cast("string"), F.lit("%"))
    quoted = F.array_join(F.transform("suffixes", lambda x: F.concat(F.lit("`"), x, F.lit("`"))), ", ")
    return inventory.withColumns({"coverage": F.when(F.col("status") == "partial", percent).otherwise(NOTHING), "suffix_text": F.when(F.size("suffixes") == 0, NOTHING).otherwise(quoted)})


def suffix_usage(inventory: DataFrame) -> DataFrame:
    """suffix, directories: how many directories use it."""
    return inventory.select(F.explode("suffixes").alias("suffix")).groupBy("suffix").agg(F.count("*").alias("directories"))
