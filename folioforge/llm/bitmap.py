"""A bitmap of fixed size that tells executors which hashes recur; built by Spark, tested in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import checked, dropped, written

#: 2**28 bits: 32 MB whatever the data. A bit set by chance costs needless work and changes no result.
BITS, BLOCK = 1 << 28, 32768
#: Bits of those that Spark itself tests: 8 MB at most.
NATIVE = 1 << 26


def of_hashes(hashes: DataFrame, column: str) -> np.ndarray:
    """Bytes of a bitmap with the bits hash mod BITS of a long column set."""
    slot = F.col(column).bitwiseAND(F.lit(BITS - 1))
    rows = hashes.select(slot.alias("_s")).groupBy((F.expr(f"_s div {BLOCK}")).alias("_b")).agg(F.bitmap_construct_agg(F.col("_s") % BLOCK).alias("_m"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        at = r["_b"] * (BLOCK // 8)
        bits = np.frombuffer(r["_m"], np.uint8)
        out[at : at + len(bits)] = bits
    return out


def test(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(BITS - 1)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def maybe_in(rows: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """rows with _maybe, which is false only where no row of side has the same key.

    side reaches the rows as a broadcast bitmap of at most NATIVE bits, however many rows it has.
    """
    slot, block = F.pmod(F.xxhash64(*key), F.lit(NATIVE)).alias("_slot"), F.expr(f"_slot div {BLOCK}").alias("_block")
    bits = side.select(slot).groupBy(block).agg(F.bitmap_construct_agg(F.col("_slot") % BLOCK).alias("_bits"))
    out = rows.select("*", slot).select("*", block).join(F.broadcast(written(bits, "bitmap")), "_block", "left")
    byte = F.conv(F.hex(F.expr(f"substring(_bits, int((_slot % {BLOCK}) div 8) + 1, 1)")), 16, 10).cast("int").alias("_byte")
    out = out.select(*rows.columns, "_slot", byte)
    return out.select(*rows.columns, F.coalesce(F.expr("shiftright(_byte, int(_slot % 8)) & 1") == 1, F.lit(False)).alias("_maybe"))


def without(rows: DataFrame, narrow: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """rows whose key (of no nulls) isn't in side. narrow holds the keys of rows; only keys are shuffled.

    The bitmap passes most rows; what it holds back by chance is looked up among the keys and let through.
    """
    chance = maybe_in(narrow.select(*key), side, key).where("_maybe").drop("_maybe")
    chance = written(chance.join(checked(side.select(*key)), key, "left_anti").distinct(), "held-back")
    tested = maybe_in(rows, side, key)
    free = tested.where("not _maybe").drop("_maybe")
    if not chance.limit(1).count():
        dropped(chance)
        return free
    return free.unionByName(tested.where("_maybe").drop("_maybe").join(checked(chance), key, "left_semi").select(*rows.columns))
