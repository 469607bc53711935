"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)), linear in the features of
a text. It is fitted on a bounded sample of labelled documents and scores every whole text where it is read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import batches, held_out
from folioforge.llm.words import WordRows

#: Buckets of hashed words; rank of the interactions; labelled documents that the fit may use.
BUCKETS, RANK, SAMPLE_DOCS = 1 << 14, 8, 6000
EPOCHS, RATE, DECAY, SEED = 12, 0.08, 1e-5, 11
THRESHOLD = 0.3
#: Per word: bucket, characters, capitals, small letters, digits, other marks, capitals only, three equal marks.
WORD = 8
STATS = 14


def word_rows(words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), WORD))
    for i, w in enumerate(words):
        up, low = sum(map(str.isupper, w)), sum(map(str.islower, w))
        digits = sum(map(str.isdigit, w))
        marks = len(w) - sum(map(str.isalnum, w))
        runs = marks >= 3 and any(not c.isalnum() and w.count(c * 3) for c in set(w))
        out[i] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS, len(w), up, low, digits, marks, up > 1 and not low, runs
    return out


_WORDS = WordRows(word_rows, WORD)


def features(texts: list[str], n_chars: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, value, text of each hashed word), in text order, and a row of statistics per text."""
    flat, counts = _WORDS.rows(texts)
    sums = _WORDS.sums(flat, counts)
    bucket = _WORDS.table[flat, 0].astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    keys, times = np.unique(doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = keys // BUCKETS, keys % BUCKETS
    n = np.maximum(counts, 1)
    value = times / np.sqrt(np.maximum(np.bincount(doc, times.astype(float) ** 2, len(texts)), 1))[doc]
    most = np.zeros(len(texts))
    np.maximum.at(most, doc, times)
    chars = np.maximum(sums[:, 1], 1)
    lines = np.array([t.count("\n") + 1 for t in texts], float)
    size = np.array([len(t) if c is None else c for t, c in zip(texts, n_chars)], float)
    stats = np.c_[
        np.log1p(counts) / 5, np.log1p(np.maximum(size, 0)) / 8, sums[:, 1] / n / 8, sums[:, 2] / chars, sums[:, 3] / chars, sums[:, 4] / chars,
        sums[:, 5] / chars, sums[:, 6] / n, sums[:, 7] / n, np.bincount(doc, minlength=len(texts)) / n, most / n, np.log1p(lines) / 4, np.minimum(lines / n, 1), counts == 0,
    ]
    return bucket, value, doc, stats


class Model:
    def __init__(self, prior: float = 0.0):
        rng = np.random.default_rng(SEED)
        self.key = uuid.uuid4().hex
        self.bias = prior
        self.w = np.zeros(BUCKETS + STATS)
        self.v = rng.normal(0, 0.05, (BUCKETS + STATS, RANK))

    def raw(self, bucket, value, doc, stats):
        """(score before the sigmoid, sum of v x) of each text."""
        m = len(stats)
        starts = np.searchsorted(doc, np.arange(m))
        vx = self.v[bucket] * value[:, None]
        held = np.diff(np.append(starts, len(doc))) > 0
        s, q, linear = np.zeros((m, RANK)), np.zeros((m, RANK)), np.zeros(m)
        if held.any():
            s[held] = np.add.reduceat(vx, starts[held], axis=0)
            q[held] = np.add.reduceat(vx * vx, starts[held], axis=0)
            linear[held] = np.add.reduceat(self.w[bucket] * value, starts[held])
        sv, sw = self.v[BUCKETS:], self.w[BUCKETS:]
        s += stats @ sv
        q += (stats**2) @ (sv**2)
        return self.bias + linear + stats @ sw + 0.5 * (s**2 - q).sum(axis=1), s

    def scores(self, texts: list[str], n_chars: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*features(texts, n_chars))[0], -30, 30)))


def train(rows: list[tuple]) -> Model:
    """Adagrad over small batches; rows are (label, buckets, values, statistics)."""
    y = np.array([r[0] for r in rows], float)
    prior = np.clip(y.mean(), 0.02, 0.98)
    model, rng = Model(float(np.log(prior / (1 - prior)))), np.random.default_rng(SEED)
    size = np.array([len(r[1]) for r in rows])
    bucket, value = np.concatenate([r[1] for r in rows]).astype(np.int64), np.concatenate([r[2] for r in rows])
    start, stats = np.cumsum(size) - size, np.array([r[3] for r in rows])
    gw, gv, gb = np.full(len(model.w), 1e-6), np.full(model.v.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            n = size[some]
            of = np.repeat(np.arange(len(some)), n)
            pick = np.repeat(start[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            b, x, st = bucket[pick], value[pick], stats[some]
            raw, s = model.raw(b, x, of, st)
            err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[some]) / len(some)
            used, back = np.unique(b, return_inverse=True)
            e = err[of] * x
            dw = np.bincount(back, e, len(used)) + DECAY * model.w[used]
            vx = model.v[b]
            dv = np.stack([np.bincount(back, e * (s[of, f] - vx[:, f] * x), len(used)) for f in range(RANK)], axis=1) + DECAY * model.v[used]
            sv = model.v[BUCKETS:]
            sw = err @ st + DECAY * model.w[BUCKETS:]
            sd = (st * err[:, None]).T @ s - ((st**2) * err[:, None]).sum(axis=0)[:, None] * sv + DECAY * sv
            for index, d, w, g in ((used, dw, model.w, gw), (used, dv, model.v, gv), (slice(BUCKETS, None), sw, model.w, gw), (slice(BUCKETS, None), sd, model.v, gv)):
                g[index] += d * d
                w[index] -= RATE * d / np.sqrt(g[index])
            gb += err.sum() ** 2
            model.bias -= RATE * err.sum() / np.sqrt(gb)
    return model


def _inputs(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    chars = F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), chars.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> Model:
    """A model fitted on at most sample_docs label rows, the first by a hash of their id, and their whole texts.

    Null labels and ids are left out; without any labelled text the model gives 0.5 everywhere.
    """
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
    own = own.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample_docs)
    rows = _inputs(docs, id_col, text_col, chars_col)
    rows = rows.join(F.broadcast(own), rows["doc_id"] == own["_id"]).select("doc_id", "_y", "text", "n_chars")

    def run(it):
        for batch in batches(it):
            ids, y, texts, chars = (c.to_pylist() for c in batch.columns)
            bucket, value, doc, stats = features([t or "" for t in texts], chars)
            ends = np.searchsorted(doc, np.arange(len(texts) + 1))
            cut = [(bucket[a:b].astype("<i4").tobytes(), value[a:b].astype("<f4").tobytes()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y, pa.int32()), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary()), pa.array([s.astype("<f8").tobytes() for s in stats], pa.binary())], names=["doc_id", "y", "b", "x", "s"])

    got = rows.mapInArrow(run, "doc_id long, y int, b binary, x binary, s binary").collect()
    got = sorted((r["doc_id"], r["y"], bytes(r["b"]), bytes(r["x"]), bytes(r["s"])) for r in got)
    if not got:
        model = Model()
        model.v[:] = 0
        return model
    return train([(y, np.frombuffer(b, "<i4"), np.frombuffer(x, "<f4").astype(float), np.frombuffer(s, "<f8")) for _, y, b, x, s in got])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """One row per input row: doc_id, score. Null texts count as empty; other columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        for batch in batches(it):
            out = shared.value.scores([t or "" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], schema=schema)

    return _inputs(docs, id_col, text_col, chars_col).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, the fit using label rows that are not held out."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), sample_docs=sample_docs)
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
