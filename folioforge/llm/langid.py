"""Language identification by interpolated Kneser-Ney character models, one per language.

Models are fitted on a bounded sample of labelled documents and kept as sorted arrays of n-gram hashes, with a
column per language; every language's model is interpolated from its own counts alone. Words are modelled one
by one between boundary marks, so a word's log probability is computed once per worker and looked up after. The
language of lowest cross-entropy per character wins; a text whose lowest one is above the level that its language
shows on documents kept out of the fit is marked as rejected.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import batches, held_out
from folioforge.llm.words import WordRows

#: Length of the n-grams; documents of each language in the sample, in expectation; share of it that calibrates.
ORDER, SAMPLE_DOCS, CALIBRATE = 4, 600, 0.2
#: Quantile of the calibrating documents' cross-entropy, plus slack in nats, plus SHORT / sqrt(letters).
QUANTILE, SLACK, SHORT = 0.999, 0.4, 3.0
#: Bytes of text that are split into words at once.
BATCH = 1 << 20
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MULTIPLIER, MIX, WORD = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), (1 << 64) - 1


def _grams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(place in its piece, which piece, hash of the k-gram that ends there for k = 0..ORDER) of each character.

    A piece is spelt between marks. Hashes of grams that would begin before the first mark are meaningless.
    """
    text = "".join(f"\x02{p}\x03" for p in pieces)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(p) + 2 for p in pieces), np.int64, len(pieces))
    piece = np.repeat(np.arange(len(pieces)), lengths)
    place = np.arange(len(code)) - (np.cumsum(lengths) - lengths)[piece]
    hashes = [np.full(len(code), MIX)]
    power = 1
    rolled = np.zeros(len(code), np.uint64)
    for k in range(1, ORDER + 1):
        shifted = np.zeros(len(code), np.uint64)
        shifted[k - 1 :] = code[: len(code) - k + 1] if k > 1 else code
        rolled = rolled + (shifted + np.uint64(1)) * np.uint64(power)
        power = power * MULTIPLIER & WORD
        x = rolled + np.uint64(k * int(MIX) & WORD)
        x = (x ^ (x >> np.uint64(29))) * MIX
        hashes.append(x ^ (x >> np.uint64(32)))
    return place, piece, hashes


def _before(h: np.ndarray) -> np.ndarray:
    """The hash that ends one character earlier."""
    return np.concatenate([h[:1], h[:-1]])


def _fit_one(words: Counter) -> list[tuple[dict[str, np.ndarray], ...]]:
    """Per order, (gram hashes, discounted shares) and (context hashes, weights of the lower order)."""
    pieces = list(words)
    times = np.fromiter((words[p] for p in pieces), np.float64, len(pieces))
    place, piece, hashes = _grams(pieces)
    out = []
    for k in range(1, ORDER + 1):
        here = (place >= k - 1) & (place >= 1)
        gram, context = hashes[k][here], (_before(hashes[k - 1]) if k > 1 else hashes[0])[here]
        weight = times[piece[here]]
        keys, first, of = np.unique(gram, return_index=True, return_inverse=True)
        if k == ORDER:
            count = np.bincount(of, weight, len(keys))
        else:  # continuation counts: distinct characters before the gram; raw counts where it begins a piece
            longer = (place >= k) & (place >= 1)
            pairs = np.unique(hashes[k + 1][longer], return_index=True)[1]
            ends = hashes[k][longer][pairs]
            count = np.zeros(len(keys))
            np.add.at(count, np.searchsorted(keys, ends), 1.0)
            starts = place[here] == k - 1
            count += np.bincount(of[starts], weight[starts], len(keys))
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        contexts, place_of = np.unique(context[first], return_inverse=True)
        total = np.bincount(place_of, count, len(contexts))
        kinds = np.bincount(place_of, (count > 0).astype(float), len(contexts))
        share = np.maximum(count - discount, 0) / np.maximum(total[place_of], 1e-12)
        lower = np.where(total > 0, np.minimum(1.0, discount * kinds / np.maximum(total, 1e-12)), 1.0)
        out.append(((keys, share), (contexts, lower)))
    return out


def _joined(tables: list[tuple[np.ndarray, np.ndarray]], absent: float) -> tuple[np.ndarray, np.ndarray]:
    """One sorted hash array with a column of values per language."""
    keys = np.unique(np.concatenate([k for k, _ in tables]))
    values = np.full((len(keys) + 1, len(tables)), absent, np.float32)  # the last row stands for unseen hashes
    for i, (k, v) in enumerate(tables):
        values[np.searchsorted(keys, k), i] = v
    return keys, values


def _look(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return values[np.full(len(wanted), -1)]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[np.where(keys[at] == wanted, at, -1)]


class Model:
    """languages, their n-gram tables and, once calibrated, their rejection levels."""

    def __init__(self, counts: dict[str, Counter]):
        self.key = uuid.uuid4().hex
        self.languages = sorted(counts)
        fits = [_fit_one(counts[x]) for x in self.languages]
        self.tables = [(_joined([f[k][0] for f in fits], 0.0), _joined([f[k][1] for f in fits], 1.0)) for k in range(ORDER)]
        self.floor = 1.0 / (1 + max(len({c for w in counts[x] for c in w}) for x in self.languages))
        self.levels = np.full(len(self.languages), np.inf)

    def piece_scores(self, pieces: list[str]) -> np.ndarray:
        """Log probability of each piece under each language."""
        out = np.zeros((len(pieces), len(self.languages)))
        for at in range(0, len(pieces), 50_000):
            some = pieces[at : at + 50_000]
            place, piece, hashes = _grams(some)
            p = np.full((len(place), len(self.languages)), self.floor, np.float32)
            for k in range(1, ORDER + 1):
                here = np.flatnonzero((place >= k - 1) & (place >= 1))
                grams, contexts = self.tables[k - 1]
                before = (_before(hashes[k - 1]) if k > 1 else hashes[0])[here]
                p[here] = _look(grams, hashes[k][here]) + _look(contexts, before) * p[here]
            logs = np.log(p.astype(np.float64))
            logs[place == 0] = 0
            starts = np.flatnonzero(place == 0)
            out[at : at + len(some)] = np.add.reduceat(logs, starts, axis=0)
        return out

    def word_rows(self, words: list[str]) -> np.ndarray:
        """For each word, its letter runs' summed log probabilities and, last, the characters predicted."""
        runs = [LETTERS.findall(w.lower()) for w in words]
        pieces = {p: i for i, p in enumerate(dict.fromkeys(p for r in runs for p in r))}
        out = np.zeros((len(words), len(self.languages) + 1))
        if pieces:
            scores = np.c_[self.piece_scores(list(pieces)), [len(p) + 1 for p in pieces]]
            flat = np.fromiter((pieces[p] for r in runs for p in r), np.int64)
            of = np.repeat(np.arange(len(words)), [len(r) for r in runs])
            for c in range(out.shape[1]):
                out[:, c] = np.bincount(of, scores[flat, c], len(words))
        return out


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.words = WordRows(model.word_rows, len(model.languages) + 1)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per predicted character and language, predicted characters) of each text."""
        sums = self.words.sums(*self.words.rows(texts))
        n = np.rint(sums[:, -1])
        return -sums[:, :-1] / np.maximum(n, 1)[:, None], n


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """The worker's scorer of that model; its memo stays from task to task."""
    if model.key not in _SCORERS:
        _SCORERS.clear()  # an older model's memo goes with it
        _SCORERS[model.key] = Scorer(model)
    return _SCORERS[model.key]


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A calibrated model of every language of labelled, or None if no labelled text has a letter.

    About sample_docs documents of each language are drawn by a hash of their id, so the driver holds a bounded
    sample; whole texts are used.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    sizes = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}
    part = F.pmod(F.xxhash64(F.coalesce(F.col("i").cast("string"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share: Column = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("l") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    sample = sorted((r["l"], r["i"] if r["i"] is not None else -1, r["t"]) for r in rows.where(part < share).collect())
    split = {lang: [[], []] for lang, _, _ in sample}
    for n, (lang, _, text) in enumerate(sample):
        split[lang][n % round(1 / CALIBRATE) == 0].append(text)
    counts = {}
    for lang, (used, kept) in split.items():
        c = Counter()
        for text in used or kept:
            c.update(LETTERS.findall(text.lower()))
        if c:
            counts[lang] = c
    if not counts:
        return None
    model = Model(counts)
    for i, lang in enumerate(model.languages):
        used, kept = split[lang]
        entropy, n = Scorer(model).entropies(kept or used)
        best = (entropy[:, i] - SHORT / np.sqrt(np.maximum(n, 1)))[n > 0]
        if len(best):
            model.levels[i] = np.quantile(best, QUANTILE) + SLACK
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, cross_entropy, rejected.

    Every whole text is scored. A null text, one without a letter, and any text where there is no model gets
    `und`, score 0 and rejected. score is the softmax over languages of the log likelihood of at most 40
    characters of mean entropy. Ties go to the first language by name. Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        model = shared.value
        for batch in batches(it, BATCH):
            ids = batch.column(0).cast(pa.int64())
            if model is None:
                cols = [["und"] * len(ids), [0.0] * len(ids), [None] * len(ids), [True] * len(ids)]
            else:
                entropy, n = _scorer(model).entropies([t or "" for t in batch.column(1).to_pylist()])
                best, some = entropy.argmin(axis=1), n > 0
                low = entropy[np.arange(len(best)), best]
                odds = np.exp(-(entropy - low[:, None]) * np.minimum(n, 40)[:, None]).sum(axis=1)
                far = ~some | (low > model.levels[best] + SHORT / np.sqrt(np.maximum(n, 1)))
                cols = [[model.languages[b] if s else "und" for b, s in zip(best, some)], np.where(some, 1 / odds, 0.0), np.where(some, low, np.nan), far]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t, from_pandas=True) for c, t in zip(cols, schema.types[1:]))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """predict() with a model fitted on the documents that are not held out, with held_out beside it."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), sample_docs)
    return predict(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
