"""Exact deduplication by progressive refinement: byte length, then prefix hash, then full hash.

Only DataFrame functions. Text never moves between executors: each level groups narrow keys, pre-aggregated
before their shuffle, and the full hash is computed inside the scan, only for rows whose length and prefix
recur. Which ones recur reaches that scan as a bitmap of fixed size, so the broadcast can't grow with the data;
a bit set by chance costs one needless hash and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import ascii_lower, written

#: Bits in one row of the bitmap (what bitmap_construct_agg holds), and rows at most: 2**26 bits, 8 MB in all.
BLOCK_BITS, BLOCKS = 32768, 2048


def _keys(text: Column, prefix: int) -> dict[str, Column]:
    norm = ascii_lower(text)
    return {"_n": F.octet_length(norm).cast("long"), "_p": F.xxhash64(F.substring(norm, 1, prefix))}


def _slot() -> Column:
    return F.pmod(F.xxhash64("_n", "_p"), F.lit(BLOCKS * BLOCK_BITS))


def recurring(keys: DataFrame) -> DataFrame:
    """Bitmap rows (_block, _bits) of the (length, prefix hash) pairs that two or more rows share."""
    pairs = keys.groupBy("_n", "_p").agg(F.count("*").alias("_c"))
    lengths = pairs.groupBy("_n").agg(F.sum("_c").alias("_t")).where("_t > 1").select("_n")
    alike = pairs.join(lengths, "_n", "left_semi").where("_c > 1").withColumn("_s", _slot())
    block = F.expr(f"_s div {BLOCK_BITS}")
    return alike.groupBy(block.alias("_block")).agg(F.bitmap_construct_agg(F.col("_s") % BLOCK_BITS).alias("_bits"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 128, digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. The largest id of
    equal texts stays. Rows that repeat an id and a text count each and share one verdict; a null id is kept
    only if its text has no other id (then keep_id is null). text_sha256 is null where refinement ended before
    the full hash, unless digest_all asks for it everywhere. Other columns are ignored, whatever their names;
    an empty input gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    keyed = rows.withColumns(_keys(F.col("_text"), prefix))
    bits = recurring(written(keyed.select("_n", "_p"), "exact-keys"))

    seen = keyed.withColumn("_s", _slot()).withColumn("_block", F.expr(f"_s div {BLOCK_BITS}"))
    seen = seen.join(F.broadcast(bits), "_block", "left")
    byte = F.conv(F.hex(F.expr(f"substring(_bits, int((_s % {BLOCK_BITS}) div 8) + 1, 1)")), 16, 10).cast("int")
    again = F.coalesce(F.expr("shiftright(_byte, int(_s % 8)) & 1") == 1, F.lit(False))
    seen = seen.withColumn("_byte", byte).withColumn("_again", again)
    digest = F.sha2(ascii_lower(F.col("_text")).cast("binary"), 256)
    narrow = seen.withColumn("_h", digest if digest_all else F.when(F.col("_again"), digest))
    narrow = written(narrow.select("doc_id", "_n", "_p", "_again", "_h"), "exact-rows")

    key = ["_n", "_p", "_h"]
    alike = narrow.where("_again")
    groups = alike.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = alike.join(groups, key).select("doc_id", "keep_id", "group_size", F.col("_h").alias("text_sha256"))
    alone = narrow.where("not _again").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.col("_h").alias("text_sha256"))
    out = both.unionByName(alone)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 128) -> DataFrame:
    """The input's rows and columns without those that exact_dedup drops; rows that repeat a kept id and text stay."""
    own = exact_dedup(docs, id_col, text_col, prefix, digest_all=True).where("not kept").select("doc_id", "text_sha256").distinct()
    digest = F.sha2(ascii_lower(docs[text_col]).cast("binary"), 256)
    return docs.join(own, docs[id_col].eqNullSafe(own["doc_id"]) & (digest == own["text_sha256"]), "left_anti")
