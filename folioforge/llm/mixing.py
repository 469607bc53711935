"""Mixing sources to target weights by weighted fair queueing.

Only DataFrame functions over narrow rows (id, source, size); the text is read once to count its words. A
document's virtual finish time is its source's cumulative size, in shuffled order, over the source's target.
Everything is sorted by that time and cut at the total budget. No source and no stretch of time is sorted in
one task: prefix sums are taken per bucket of the shuffle hash, and the cut is first found among buckets of
virtual time, then inside one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.shared import checked, word_count, written

#: Weights of the sources in code point order, repeating; most times that a document is taken.
WEIGHTS, MOST = (5, 2, 1), 3
#: Leading hex digits of the shuffle hash that name a bucket; buckets of virtual time.
HEX, SLOTS = 4, 65536


def order_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def targets(base: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, largest, target.

    Targets share the total size by weight; one above `most` times its source's size is held there and the
    excess reshared by weight among the others, until none is above: with sources in order of cap / weight, the
    level is that of the first source which is not above it. One row per source meets in one task here.
    """
    by = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    every = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int")).cast("double")
    by = by.withColumn("turn", turn).withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by = by.withColumn("total", F.sum("source_size").over(every)).withColumn("per", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("per", "turn")
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", (F.col("total") - before).cast("double") / left).withColumn("at", F.row_number().over(rising))
    first = F.min(F.when(F.col("level") <= F.col("per"), F.struct("at", "level"))).over(every)
    by = by.withColumn("first", first)
    target = F.when(F.col("at") < F.col("first.at"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("first.level"))
    return by.select("source", "source_size", "largest", target.alias("target"))


def _mixed(docs: DataFrame, weights, most: int, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), order_key(F.col(id_col), seed).alias("_k"))
    base = written(base, "mix-sizes").withColumn("_b", F.substring("_k", 1, HEX))
    goals = written(targets(base, weights, most), "mix-targets").withColumnRenamed("source", "_source")
    n_goals = goals.count()

    sums = base.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_src"), F.col("_b").alias("_bb"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    rows = base.join(sums, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_b") == F.col("_bb"))).drop("_src", "_bb")
    inside = Window.partitionBy("source", "_b").orderBy("_k", "doc_id", "size")
    rows = rows.withColumn("_c", F.col("_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = written(rows.drop("_before"), "mix-order")
    rows = rows.join(checked(goals, n_goals), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def finish(e: int) -> Column:
        return F.when(F.col("target") > 0, (F.col("source_size") * e + F.col("_c")).cast("double") / F.col("target")).otherwise(F.lit(0.0))

    # By this time every source has had its target, even if its largest document is still open: the cut lies before.
    last = goals.agg((F.lit(1.0) + F.coalesce(F.max(F.when(F.col("target") > 0, F.col("largest") / F.col("target"))), F.lit(0.0))).alias("_last"), F.coalesce(F.sum("source_size"), F.lit(0)).alias("_budget"))
    last_at, budget = last.first()
    slot = F.floor(F.col("_v") / F.lit(last_at) * SLOTS)
    turns = F.array(*[F.struct(finish(e).alias("_v"), F.lit(e).alias("_e")) for e in range(most)])
    items = rows.select("size", "source", "_k", F.explode(F.filter(turns, lambda t: t["_v"] <= last_at)).alias("_i")).select("size", "source", "_k", "_i.*")
    items = items.withColumn("_slot", slot)
    slots = items.groupBy("_slot").agg(F.sum("size").alias("_sum"))
    slots = slots.withColumn("_to", F.sum("_sum").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)))
    cut = slots.where(F.col("_to") > budget).agg(F.min_by(F.struct("_slot", (F.col("_to") - F.col("_sum")).alias("_had")), "_slot").alias("c")).first()["c"]
    if cut is None:  # the whole queue fits
        taken = [F.lit(1) * (finish(e) <= last_at).cast("int") for e in range(most)]
    else:
        key = ["_v", "_k", "_e", "source"]
        edge = items.where(F.col("_slot") == cut["_slot"])
        peers = Window.orderBy(*key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        edge = edge.withColumn("_run", F.sum("size").over(peers) + cut["_had"]).where(F.col("_run") <= budget)
        end = edge.agg(F.max(F.struct(*key)).alias("end")).first()["end"]
        if end is None:  # nothing of that slot fits
            taken = [(F.floor(finish(e) / F.lit(last_at) * SLOTS) < cut["_slot"]).cast("int") for e in range(most)]
        else:
            bound = F.struct(F.lit(end["_v"]).alias("_v"), F.lit(end["_k"]).alias("_k"), F.lit(end["_e"]).alias("_e"), F.lit(end["source"]).cast("string").alias("source"))
            taken = [(F.struct(finish(e).alias("_v"), F.col("_k"), F.lit(e).alias("_e"), F.col("source")) <= bound).cast("int") for e in range(most)]
    return rows.withColumn("times", sum(taken[1:], taken[0]))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words taken, repeats counted), times.

    Null sources form one source, last in order; null texts have size 0; a null id is an id of its own. Rows
    that repeat id, source and size tie and are cut together. The same input and seed give the same mix however
    it is partitioned. Other columns are ignored. An empty input gives an empty result.
    """
    rows = _mixed(docs, weights, most, seed, id_col, text_col, source_col)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The input's columns; a row as many times as the mix takes it, none if that is 0 or it has no word."""
    times = _mixed(docs, weights, most, seed, id_col, text_col, source_col).where("times > 0 and size > 0")
    times = written(times.select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_size"), "times").distinct(), "mix-times")
    times = checked(times)
    same = docs[id_col].eqNullSafe(times["_id"]) & docs[source_col].cast("string").eqNullSafe(times["_src"]) & (word_count(docs[text_col]) == times["_size"])
    row = F.struct(*[docs[c].alias(c) for c in docs.columns])
    return docs.join(times, same).select(F.explode(F.array_repeat(row, times["times"].cast("int"))).alias("row")).select("row.*")
