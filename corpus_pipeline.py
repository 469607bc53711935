"""Corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder
and rereads it as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import jaccard_join, langid, line_dedup, mixing, packing
from folioforge.llm.queries import tokenizer_path
from folioforge.llm.shared import checked, held_out, written

#: Percent of a line's words that a near copy may differ in, rounded.
LINE_PERCENT = 5


def _text_hash() -> Column:
    return F.xxhash64("text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models don't reject. Each row goes by its own text's verdict, whatever its id."""
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    verdicts = langid.predict(docs.select(_text_hash().alias("_text"), "text"), model, id_col="_text")
    rejected = checked(written(verdicts.where("rejected").select(F.col("doc_id").alias("_gone")).distinct(), "rejected"))
    return docs.join(rejected, _text_hash() == F.col("_gone"), "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one but for a twentieth of the words; n_chars follows the text."""
    out = line_dedup.without_lines(docs, percent=LINE_PERCENT)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def _once(docs: DataFrame) -> DataFrame:
    """docs with one row (the least) of those that repeat id and text, null equal to null."""
    keys = docs.select("doc_id", _text_hash().alias("_text"))
    again = written(keys.groupBy("doc_id", "_text").count().where("count > 1").select(F.col("doc_id").alias("_id"), "_text"), "repeated-rows")
    if not again.limit(1).count():
        return docs
    same = docs["doc_id"].eqNullSafe(again["_id"]) & (F.xxhash64(docs["text"]) == again["_text"])
    one = docs.join(checked(again), same, "left_semi").groupBy("doc_id", _text_hash().alias("_text")).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return docs.join(checked(again), same, "left_anti").unionByName(one.select("row.*"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id; of rows that repeat id and text, one."""
    found = jaccard_join.jaccard_components(docs)
    linked = checked(written(found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "ids"))
    return _once(docs.join(linked, docs["doc_id"] == F.col("_gone"), "left_anti"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document that the mix repeats is packed as often."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("source_mix", mixing_stage),
    ("packing", packing_stage),
]

#: Language models, banded edit joins and a tokenizer are beyond SQL; tests/llm/test_pipeline.py checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's pieces, from all documents of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
