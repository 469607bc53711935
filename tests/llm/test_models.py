"""Mixing against brute force; models by held-out accuracy and recall; odd rows everywhere."""

import hashlib
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import langid, mixing, neighbours, quality, shared, words
from folioforge.llm.queries import QUERIES, SQL, table
from folioforge.llm.shared import word_count

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_word_count(spark):
    texts = [None, "", " \n", "a", " a\tb\x0b c\r\n", "a\x85b\xa0c", "x" * 100_000 + " y"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(word_count(F.col("t"))).collect()]
    assert got == [0, 0, 0, 1, 3, 1, 2]


def brute_mix(rows, weights=(5, 2, 1), most=3):
    sizes = {}
    for i, s, n in rows:
        sizes.setdefault(s, []).append((hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest(), i, n))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    size = {s: sum(n for _, _, n in sizes[s]) for s in order}
    total, target, free = sum(size.values()), {}, set(order)
    while True:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * level > most * size[s] * (1 + 1e-12)]
        if not above:
            return size, target | {s: weight[s] * level for s in free}, total
        for s in above:
            target[s] = most * size[s]
            free.remove(s)


MIX = [(i, "abc"[min(2, i % 7 // 2)] if i % 11 else None, (i * 37) % 50) for i in range(300)]


@pytest.mark.parametrize("rows", [MIX, [(i, s, n) for i, s, n in MIX if s == "a"], [(i, "b" if i else "a", 0 if i % 2 else 9) for i in range(40)], [(1, "a", 5)], [(1, None, 0), (None, "a", 0)]])
def test_mix(spark, rows):
    docs = spark.createDataFrame([(i, s, " ".join(["w"] * n) if n or i != 1 else None, 1, "z") for i, s, n in rows], "doc_id long, source string, text string, size int, target string")
    size, target, total = brute_mix(rows)
    got = mixing.mix(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((i, n) for i, s, n in rows), key=repr)
    of = {i: s for i, s, _ in rows}
    taken = {}
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    largest = max(n for _, _, n in rows)
    assert sum(taken.values()) <= total
    assert all(abs(taken[s] - target[s]) <= largest * len(target) for s in target)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert copies.select(F.sum(word_count(F.col("text")))).first()[0] in (sum(r.taken for r in got), None)


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(docs).count() == 0 and mixing.mixed_documents(docs).count() == 0


def test_repeated_rows_are_cut_together(spark):
    docs = spark.createDataFrame([(i // 2, "a", "w w w") for i in range(40)], "doc_id long, source string, text string")
    times = {}
    for r in mixing.mix(docs).collect():
        times.setdefault(r.doc_id, set()).add(r.times)
    assert all(len(t) == 1 for t in times.values())


@tables
def test_language(spark):
    docs = table(spark, SF, "documents")
    got = QUERIES["op10_language"](spark, SF)
    both = docs.select("doc_id", "lang").join(got, "doc_id")
    held = both.where("held_out")
    assert got.count() == docs.count() and held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    assert got.where("rejected").count() <= 0.01 * docs.count()


def test_language_of_odd_rows(spark):
    text = ["the cat sat on the mat and ate", "le chat est sur la table et mange", "der Hund liegt auf dem Bett und frisst"]
    rows = [(i, text[i % 3] + " " + str(i), ("en", "fr", "de")[i % 3], 1, "x") for i in range(90)] + [(100, None, "en", 1, "x"), (101, "12 ²³ !!", "fr", 1, "x"), (None, "the mat", None, 1, "x"), (102, "", None, 1, "x"), (103, "the cat " * 30_000, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, held_out string")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, None, 103)] == ["en", "fr", "de", "en", "en"]
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (100, 101, 102)] == [("und", 0.0, True)] * 3
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"} and langid.identify(docs.limit(0)).count() == 0


def plain_kneser_ney(words, floor, order=langid.ORDER):
    """Probability of a character after a history (which begins with the first mark), by dictionaries."""
    shares, lowers = {}, {}
    for k in range(1, order + 1):
        count, longer = {}, set()
        for w, n in words.items():
            s = f"\x02{w}\x03"
            for end in range(max(k, 2), len(s) + 1):
                gram = s[end - k : end]
                count.setdefault(gram, 0)
                if k == order or end == k:
                    count[gram] += n
                elif end > k:
                    longer.add(s[end - k - 1 : end])
        for gram in longer:
            count[gram[1:]] += 1
        ones, twos = (sum(c == x for c in count.values()) for x in (1, 2))
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        for context in {g[:-1] for g in count}:
            own = {g: c for g, c in count.items() if g[:-1] == context}
            shares |= {g: (c - discount) / sum(own.values()) for g, c in own.items()}
            lowers[context] = discount * len(own) / sum(own.values())

    def p(history, c):
        out, s = floor, history + c
        for k in range(1, min(order, len(s)) + 1):
            out = shares.get(s[-k:], 0) + lowers.get(s[-k:-1], 1) * out
        return out

    return p


def test_kneser_ney_equals_a_plain_one_that_sums_to_one():
    counts = {"x": langid.Counter({"abab": 3, "ba": 2, "abc": 1, "cabbac": 5}), "y": langid.Counter({"zz": 1, "zy": 4})}
    model = langid.Model(counts)
    pieces = ["", "a", "abab", "abba", "cabbac", "cc", "zz", "zyzy", "q", "abq"]
    got = model.piece_scores(pieces)
    for i, lang in enumerate(model.languages):
        p = plain_kneser_ney(counts[lang], model.floor)
        for j, piece in enumerate(pieces):
            s = f"\x02{piece}\x03"
            assert got[j, i] == pytest.approx(sum(math.log(p(s[:n], s[n])) for n in range(1, len(s))), rel=1e-4)
    p = plain_kneser_ney(counts["x"], model.floor)
    for history in ("\x02", "\x02a", "\x02ab", "\x02cabba", "\x02cc", "\x02zz"):
        assert sum(p(history, c) for c in "abc\x03") == pytest.approx(1)


def test_a_language_that_was_not_learned_is_rejected(spark):
    text = ["the cat sat on the mat and ate", "le chat est sur la table et mange", "der Hund liegt auf dem Bett und frisst"]
    rows = [(i, text[i % 3] + " " + str(i), ("en", "fr", "de")[i % 3]) for i in range(90)]
    other = ["кошка сидит на столе и ест рыбу " * 20, "zxqv kjwq vvxz qqkj xzvw " * 20]
    docs = spark.createDataFrame(rows + [(1000 + i, t, None) for i, t in enumerate(other)] + [(2000, "the cat ate on the mat " * 20, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.rejected for r in langid.identify(docs).collect()}
    assert got[1000] and got[1001] and not got[2000]


@tables
def test_quality(spark):
    got = QUERIES["op5_quality"](spark, SF)
    both = table(spark, SF, "labels").join(got.where("held_out"), "doc_id")
    n = both.count()
    assert both.where("quality = predicted").count() >= 0.93 * n
    assert got.count() == table(spark, SF, "documents").count() and got.where("score is null or score < 0 or score > 1").count() == 0


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, 0), (2, "", 0, 0), (None, "some words", 10, 0), (4, "x " * 200_000, None, 0), (5, "a b", 3, 0), (5, "a b", 3, 0)], "doc_id long, text string, n_chars long, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (5, 1), (77, 0)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5} and quality.classify(docs.limit(0), labels).count() == 0
    assert quality.classify(docs.drop("n_chars"), labels).count() == 6


def test_machine_equals_pairwise_sum():
    m = quality.Model(0.3)
    rng = np.random.default_rng(1)
    m.w[:] = rng.normal(0, 1, len(m.w))
    bucket, value, stats = np.array([3, 9, 700]), np.array([0.5, 1.0, 2.0]), rng.normal(0, 1, (1, quality.STATS))
    raw = m.raw(bucket, value, np.zeros(3, int), stats)[0][0]
    index, x = np.r_[bucket, quality.BUCKETS + np.arange(quality.STATS)], np.r_[value, stats[0]]
    pairs = sum(m.v[a] @ m.v[b] * p * q for i, (a, p) in enumerate(zip(index, x)) for b, q in list(zip(index, x))[:i])
    assert raw == pytest.approx(m.bias + m.w[index] @ x + pairs)


@pytest.mark.parametrize("piece", [4096, 7])
def test_neighbours(spark, monkeypatch, piece):
    monkeypatch.setattr(neighbours, "SLICE", piece)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 3, (20, 8))
    v = (centres[rng.integers(0, 20, 1500)] + rng.normal(0, 1, (1500, 8))).astype(np.float32)
    v[100:400] = v[100]
    rows = [(i, x.tolist(), 1, 2) for i, x in enumerate(v)]
    odd = [(9000, None, 1, 2), (9100, [0.0] * 8, 1, 2), (9200, [1.0, None] + [0.0] * 6, 1, 2), (9300, [float("nan")] * 8, 1, 2), (9400, [1.0] * 7, 1, 2), (None, [1.0] * 8, 1, 2)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, leaf int, rank int")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert sorted(got) == list(range(0, 1500, 50))
    hits, own = 0, v.astype(np.float64)
    for q, found in got.items():
        d = np.sqrt(((own - own[q]) ** 2).sum(axis=1))
        true = sorted((d[i], i) for i in range(1500) if i != q)[:10]
        assert len(found) == 10 and found == sorted(found) and all(s == d[i] for s, i in found)
        hits += len({i for _, i in true} & {i for _, i in found})
    assert hits >= 0.9 * 10 * len(got)


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in neighbours.search(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 2), (0, 3, 1)]
    assert neighbours.search(df.limit(0), F.col("vec_id") == 0).count() == 0


@tables
@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    got, want = QUERIES[name](spark, SF), con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    pick = lambda names, rows: sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in rows), key=repr)
    assert pick(got.columns, got.collect()) == pick(want.columns, want.fetchall())


def test_rows_of_many_new_words_are_made_in_parts():
    asked = []
    rows = words.WordRows(lambda new: asked.append(len(new)) or np.array([[float(w)] for w in new]), 1)
    flat, counts = rows.rows([" ".join(map(str, range(20_000))), "7 20001 7"])
    assert max(asked) <= words.MADE and sum(asked) == 20_001
    assert rows.table[flat, 0].tolist() == [*map(float, range(20_000)), 7.0, 20_001.0, 7.0] and counts.tolist() == [20_000, 3]


def test_written_hands_python_small_batches(spark):
    def size(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    before = spark.conf.get(shared.ARROW_SETTING)
    got = shared.written(spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 5000).alias("t")).mapInArrow(size, "n long, bytes long"), "sizes").collect()
    assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 1.1 * shared.ARROW_BYTES
    assert spark.conf.get(shared.ARROW_SETTING) == before


def test_a_tokenizer_goes_when_another_operator_takes_over():
    pytest.importorskip("public_tokenizers")
    from folioforge.llm.queries import tokenizer_path
    from folioforge.llm.tokens import encoder

    enc = encoder(tokenizer_path())
    ids = enc.encode("Some words, some more")
    words.WordRows(lambda new: np.zeros((len(new), 1)), 1).rows(["other words"])
    assert encoder.cache_info().currsize == 0 and enc.encode("Some words, some more") == ids
