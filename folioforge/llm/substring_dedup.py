"""Substring deduplication: repeated windows of words are found by Rabin-Karp hashes and cut out.

Counting every window in Spark would shuffle several times the text. Two equal windows also have equal
anchors: the least hash among the word runs of length ANCHOR inside. Anchors are few (neighbouring windows share
them), so these are counted first, and only windows whose anchor occurs in two documents go on; none that
repeats is left out. Their hashes (96 bits) are then grouped for the smallest document, pre-aggregated before
the shuffle, and joined back, which Spark splits where one passage is in very many documents. Starts merge into
maximal intervals per document, and texts are read once more to apply them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm import bitmap, rolling
from folioforge.llm.shared import batches, checked, written

WINDOW, ANCHOR = 50, 30
#: Bytes of text in a numpy batch.
BATCH = 4 << 20


def _texts(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def _windows(ids: np.ndarray, texts: list[bytes], window: int, anchor: int, lanes: int):
    """For stretches of a batch: (id, start in its text, anchor, hashes per lane) of each window."""
    words, counts = rolling.word_hashes(texts, lower=False)
    for docs, first, taken, where in rolling.stretches(counts, window - 1):
        own = words[where]
        starts = rolling.inside(taken, window)
        if not len(starts):
            continue
        doc = np.repeat(np.arange(len(docs)), taken)
        low = rolling.least(rolling.rolled(own[:, 0], anchor), window - anchor + 1)[starts]
        place = starts - (np.cumsum(taken) - taken)[doc[starts]] + first[doc[starts]]
        yield ids[docs[doc[starts]]], place, low, [rolling.rolled(own[:, i], window, i)[starts] for i in range(lanes)]


def removals(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, cuts): maximal intervals [first word, word after the last) to remove, in order.

    A window goes if the same words start in a document with a smaller id. Null ids have no order: their texts
    neither lose words nor make others lose any. Rows that repeat an id count as one document.
    """
    spark = docs.sparkSession
    anchor = min(ANCHOR, window)
    rows = _rows(docs, id_col, text_col).where("doc_id is not null")

    def anchors(it):
        for b in batches(it, BATCH):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for doc, _, low, _ in _windows(ids, _texts(b), window, anchor, 0):
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(low[new].view(np.int64)), pa.array(doc[new])], names=["a", "d"])

    seen = rows.mapInArrow(anchors, "a long, d long").groupBy("a").agg(F.min("d").alias("m"), F.max("d").alias("n"))
    shared = spark.sparkContext.broadcast(bitmap.of_hashes(seen.where("m < n"), "a"))

    def windows(it):
        for b in batches(it, BATCH):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for doc, place, low, (h, g) in _windows(ids, _texts(b), window, anchor, 2):
                some = bitmap.test(shared.value, low)
                yield pa.RecordBatch.from_arrays([pa.array(h[some].view(np.int64)), pa.array(g[some].view(np.int64).astype(np.int32)), pa.array(doc[some]), pa.array(place[some].astype(np.int32))], names=["h", "g", "d", "p"])

    found = written(rows.mapInArrow(windows, "h long, g int, d long, p int"), "windows")
    first = found.groupBy("h", "g").agg(F.min("d").alias("m"), F.max("d").alias("n")).where("m < n").select("h", "g", "m")
    later = found.join(first, ["h", "g"]).where("d > m").select("d", "p")

    order = Window.partitionBy("d").orderBy("p")
    fresh = F.coalesce(F.col("p") - F.lag("p").over(order) > window, F.lit(True)).cast("int")
    runs = later.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    cuts = runs.groupBy("d", "_run").agg(F.min("p").alias("from"), (F.max("p") + window).alias("to"))
    cuts = cuts.groupBy(F.col("d").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("cuts"))
    return written(cuts, "cuts").withColumnRenamed("_id", "doc_id")


def _applied(docs: DataFrame, window: int, id_col: str, text_col: str, make, schema: pa.Schema, ddl: str) -> DataFrame:
    cuts = removals(docs, window, id_col, text_col).withColumnRenamed("doc_id", "_id")
    rows = _rows(docs, id_col, text_col)
    rows = rows.join(checked(cuts), rows["doc_id"] == cuts["_id"], "left")
    rows = rows.select("doc_id", "text", F.expr("transform(cuts, c -> c.from)").alias("a"), F.expr("transform(cuts, c -> c.to)").alias("b"))

    def apply(it):
        for batch in batches(it, BATCH):
            out = []
            for doc, text, a, b in zip(batch.column(0).to_pylist(), _texts(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split()
                kept = words
                if a:
                    kept, at = [], 0
                    for x, y in zip(a, b):
                        kept += words[at:x]
                        at = y
                    kept += words[at:]
                out.append((doc, *make(words, kept)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return rows.mapInArrow(apply, ddl)


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Words are runs of anything but ASCII white space, unchanged; null texts have none. Texts shorter than the
    window lose nothing. Other columns are ignored; an empty input gives an empty result. See removals().
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    make = lambda words, kept: (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return _applied(docs, window, id_col, text_col, make, schema, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def kept_texts(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text: the kept words joined by one space."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    return _applied(docs, window, id_col, text_col, lambda words, kept: (b" ".join(kept).decode("utf-8", "replace"),), schema, "doc_id long, text string")
