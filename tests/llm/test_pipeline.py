"""The pipeline's stages against brute force, with nulls, copies, near copies and repeated rows."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from folioforge.llm import langid, mixing, shared

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ENGLISH = "the quick brown fox and the lazy dog went over that hill with some water for them".split()
GERMAN = "der schnelle braune fuchs und ein fauler hund gingen mit wasser zu dem berg hinauf".split()


def prose(seed, words):
    return " ".join(words[(seed * 7 + i * i + i * seed) % len(words)] for i in range(30))


def rows():
    own = [(i, prose(i, (ENGLISH, GERMAN)[i % 2]), ("en", "de")[i % 2], ("web", "book", None)[i % 3]) for i in range(60)]
    own += [(100, None, "en", "web"), (101, "", None, None), (None, None, "en", "web"), (None, "12 34", "en", "web"), (None, prose(3, GERMAN), None, "web")]
    own += [(102, "qxz jqk " * 20, None, "web"), (7, "12 34", "de", "web"), own[5], own[5], (None, "alone " + prose(8, ENGLISH), "en", None), (None, "alone " + prose(8, ENGLISH), "en", None)]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in own]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_language_stage_judges_each_row(spark, monkeypatch):
    data = rows()
    models = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    got = as_rows(corpus_pipeline.language_id(spark, frame(spark, data), ""))
    numbered = spark.createDataFrame([(n, r[1]) for n, r in enumerate(data)], "doc_id long, text string")
    bad = {r.doc_id for r in langid.predict(numbered, models[0]).where("rejected").collect()}
    assert got == sorted((r for n, r in enumerate(data) if n not in bad), key=repr)
    assert not any(r[1] in (None, "", "12 34") for r in got) and any(r[0] == 7 for r in got)


def test_line_stage_follows_text(spark):
    """A changed word in a line is near; a line of few words must be equal."""
    long = prose(1, ENGLISH) + " " + prose(2, GERMAN)
    data = [(1, long + "\nshort", "en", "web", 0), (2, long.replace("hill", "river") + "\nshort\nown", "en", None, 0), (3, None, "en", "web", None)]
    got = as_rows(corpus_pipeline.line_dedup_stage(spark, frame(spark, data), ""))
    assert got == [(1, data[0][1], "en", "web", len(data[0][1])), (2, "own", "en", None, 3), (3, None, "en", "web", None)]


def test_jaccard_stage_keeps_one(spark):
    a, b, c = ((" ".join(f"{x}{i}" for i in range(30))) for x in "abc")
    data = [(1, a, "en", "web", 1), (2, a + " x", "en", "web", 1), (3, b, "en", "web", 2), (3, b, "en", "web", 2), (3, b, "en", "book", 2), (3, c, "en", "web", 3), (None, c, "en", None, 4), (None, c, "en", None, 4), (None, None, "en", None, None), (None, None, "en", None, None)]
    got = as_rows(corpus_pipeline.jaccard_stage(spark, frame(spark, data), ""))
    assert got == sorted([data[0], data[4], data[5], data[6], data[8]], key=repr)
    assert as_rows(corpus_pipeline.jaccard_stage(spark, frame(spark, data[:1]), "")) == data[:1]


def test_mixing_stage_repeats_rows(spark):
    data = [r for r in rows() if r[0] is not None and r[0] < 60 and r[0] != 5 and r[0] != 7]
    docs = frame(spark, data)
    times = {r.doc_id: r.times if r.size else 0 for r in mixing.mix(docs).collect()}
    assert Counter(as_rows(corpus_pipeline.mixing_stage(spark, docs, ""))) == Counter({r: times[r[0]] for r in data if times[r[0]]})


def test_run_is_the_stages_in_order(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    frame(spark, rows()).write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "source_mix", "packing"]
    docs = frame(spark, rows())
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.written(stage(spark, docs, str(tmp_path)), "stage")
    got = corpus_pipeline.run(spark, str(tmp_path))
    # Sequences are numbered by partition; the pieces are the same.
    pieces = [c for c in docs.columns if "sequence" not in c][:5]
    assert got.columns == docs.columns and as_rows(got.select(pieces)) == as_rows(docs.select(pieces)) and got.count()
