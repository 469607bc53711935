"""Deduplication operators against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import bitmap, components, exact_dedup, jaccard_join, line_dedup, rolling, substring_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "doc_id long, text string, _n int, places int, d int, t string, component int, _text string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 4, "y") for i, t in rows], CLASH)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed, n=60, words=(3, 140)):
    """Documents of few words with copies, near copies, shared passages, nulls, empties and odd spaces."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6)))
    passages = [[word() for _ in range(70)] for _ in range(3)]
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two"), (1004, "one  TWO"), (1005, "one two three\x85four five six seven")]
    for i in range(n):
        kind = r.random()
        base = split(r.choice(rows)[1])
        if kind < 0.15 or kind < 0.5 and not base:
            own = base
        elif kind < 0.5:
            own = [w if r.random() > r.choice((0.005, 0.02, 0.1)) else word() for w in base]
        else:
            own = [word() for _ in range(r.randrange(*words))]
            if r.random() < 0.5:
                own[r.randrange(len(own)) :] = r.choice(passages)
        text = "".join(w + r.choice((" ", " ", "\n", "\t ")) for w in own)
        rows.append((i, text.upper() if r.random() < 0.1 else text))
    r.shuffle(rows)
    return rows


def test_exact(spark):
    rows = corpus(1) + [(None, "alone and null"), (None, "one two"), (5000, None)]
    got = exact_dedup.exact_dedup(frame(spark, rows), digest_all=True).collect()
    norm = lambda t: (t or "").translate(LOWER)
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = []
    for i, t in rows:
        own = groups[norm(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    few = exact_dedup.exact_dedup(frame(spark, rows), prefix=1)
    assert sorted((r[:4] for r in map(tuple, few.collect())), key=repr) == sorted((w[:4] for w in want), key=repr)
    kept = exact_dedup.deduplicated(frame(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((w[0] for w in want if w[3]), key=repr) and len(kept.columns) == 8
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


def cut(rows, window):
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = {p + o for p in range(len(w) - window + 1) if i is not None and first[tuple(w[p : p + window])] < i for o in range(window)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, stretch", [(50, 1 << 18), (7, 64), (3, 1 << 18)])
def test_substrings(spark, monkeypatch, window, stretch):
    monkeypatch.setattr(rolling, "STRETCH", stretch)
    rows = corpus(2) + [(None, "a " * 60), (7000, "a " * 60), (7001, "b " * 130), (7002, "b " * 130)]
    got = substring_dedup.substring_dedup(frame(spark, rows), window).collect()
    assert sorted(map(tuple, got), key=repr) == cut(rows, window)


def test_kept_texts(spark):
    rows = [(1, " ".join(map(str, range(60)))), (2, "x " + " ".join(map(str, range(60))) + " é")]
    assert {r.doc_id: r.text for r in substring_dedup.kept_texts(frame(spark, rows)).collect()} == {1: rows[0][1], 2: "x é"}
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0


def test_long_text_in_stretches(monkeypatch):
    texts = [b"a b c", b" ".join(b"w%d" % (i % 97) for i in range(500)), b"", b"x y z x y z"]
    whole = [s.tolist() for s in jaccard_join.shingle_sets(texts)]
    monkeypatch.setattr(rolling, "STRETCH", 50)
    assert [s.tolist() for s in jaccard_join.shingle_sets(texts)] == whole
    assert [len(s) for s in whole] == [1, 97, 0, 2]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def edited(r, line, n):
    line = list(line)
    for _ in range(n):
        at = r.randrange(len(line) + 1)
        kind = r.random()
        line[at : at + (kind < 0.66)] = "" if kind < 0.33 else r.choice("abcé")
    return "".join(line)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_automaton(spark, threshold):
    r = random.Random(threshold)
    pairs = []
    for _ in range(150):
        a = "".join(r.choice("abé") for _ in range(r.randrange(0, 14)))
        pairs.append((a, edited(r, a, r.randrange(0, threshold + 3))))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), threshold).alias("w")).collect()
    assert all(x.w == (distance(x.a, x.b) <= threshold) for x in got)


@pytest.mark.parametrize("many, pivots, block", [(32, 8, 2048), (2, 1, 3)])
def test_lines(spark, monkeypatch, many, pivots, block):
    monkeypatch.setattr(line_dedup, "MANY", many)
    monkeypatch.setattr(line_dedup, "PIVOTS", pivots)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    r = random.Random(5)
    bases = ["".join(r.choice("abcdefé  ") for _ in range(r.randrange(24, 60))) for _ in range(12)]
    rows = [(900, None), (901, ""), (902, "\n\n"), (903, "short\nshort"), (904, "shart\n  \n  "), (905, "a\nb\nabc\nabcd\nαβγ δεζ ηθι\nαβγ δεζ ηθκ\nαβγ xyz ηθκ"), (906, "1.\n2.\n17"), (907, "12345\n1234567\nqwertz uiop"), (None, bases[0]), (None, "only here, with a null id")]
    for i in range(70):
        rows.append((i, "\n".join(edited(r, r.choice(bases), r.choice((0, 0, 1, 2, 3, 5))) if r.random() < 0.7 else r.choice(("", "tiny", "x" * 30)) for _ in range(r.randrange(1, 6)))))
    rows += [rows[-1], (3, "another text of a repeated id")]
    own = {(i, t or "") for i, t in rows}
    hashes = {t: h for t, h in ((x.t, x.h) for x in spark.createDataFrame([(t,) for _, t in own], "t string").select("t", F.xxhash64("t").alias("h")).collect())}
    lines = sorted(((i is None, i or 0, hashes[t], p, line) for i, t in own for p, line in enumerate(t.split("\n")) if line.strip(" ")), key=lambda x: x[:4])
    want = {}
    for n, (z, i, h, p, line) in enumerate(lines):
        if any(a[:4] < lines[n][:4] and (a[4] == line or abs(len(a[4]) - len(line)) <= 2 and distance(a[4], line) <= 2) for a in lines[:n]):
            want.setdefault((None if z else i, h), set()).add(p)
    expected = []
    for i, t in rows:
        gone = want.get((i, hashes[t or ""]), set())
        parts = (t or "").split("\n")
        expected.append((i, len(parts), len(gone), hashlib.sha256("\n".join(x for p, x in enumerate(parts) if p not in gone).encode()).hexdigest()))
    got = line_dedup.line_dedup(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    kept = line_dedup.without_lines(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.where("text is null").count() == 1
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("percent, many", [(5, 32), (12, 2), (50, 32)])
def test_lines_by_words(spark, monkeypatch, percent, many):
    """With percent, as many words may differ as that share of the shorter line's, rounded."""
    monkeypatch.setattr(line_dedup, "MANY", many)
    monkeypatch.setattr(line_dedup, "PIVOTS", 1)
    monkeypatch.setattr(line_dedup, "BLOCK", 5)
    r = random.Random(percent)
    word = lambda: "".join(r.choice("abcdefé") for _ in range(r.randrange(1, 5)))
    bases = [[word() for _ in range(n)] for n in (1, 3, 9, 10, 12, 29, 30, 31, 60, 130, 270)] + [["x"] * 70]
    rows = []
    for i in range(110):
        own = list(r.choice(bases))
        for _ in range(r.randrange(0, 3 + len(own) * min(percent, 15) // 80)):
            at = r.randrange(len(own) + 1)
            kind = r.random()
            own[at : at + (kind < 0.66)] = [] if kind < 0.33 else [word()]
        rows.append((i, r.choice((" ", " ", "  ", "\t")).join(own)))
    changed = bases[4][:5] + ["edanon"] + bases[4][6:]
    rows += [(200, "\n".join((" ".join(bases[4]), " ".join(changed)))), (None, " ".join(bases[6])), (201, "\t"), (202, "\t")]
    lines = [(i, p, line) for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)) for p, line in enumerate(t.split("\n")) if line.strip(" ")]
    want = {}
    for n, (i, p, line) in enumerate(lines):
        own = split(line)
        for _, _, b in lines[:n]:
            other = split(b)
            most = (2 * percent * min(len(own), len(other)) + 100) // 200
            if b == line or most and abs(len(own) - len(other)) <= most and distance(own, other) <= most:
                want.setdefault(i, set()).add(p)
                break
    got = line_dedup.without_lines(frame(spark, rows), percent=percent)
    kept = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want.get(i, ())) for i, t in rows}
    assert {x.doc_id: x.text for x in got.collect()} == kept
    assert 1 in want[200]


def linked(rows, percent=80):
    sets = {}
    for i, t in rows:
        w = split((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("seed, block, least, percent", [(1, 1500, 128, 80), (2, 3, 1, 80), (3, 2, 10, 60)])
def test_jaccard(spark, monkeypatch, seed, block, least, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    monkeypatch.setattr(jaccard_join, "LEAST", least)
    rows = corpus(seed, 160, (3, 60))
    got = jaccard_join.jaccard_components(frame(spark, rows), percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows, percent)


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (2, "A B C D E F"), (9, None), (9, None), (8, " ")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect() if r.doc_id is not None)
    assert [x[1:] for x in got] == [(2, 2, 2), (3, 2, 2), (8, 0, 8), (9, 0, 9), (9, 0, 9)]
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [1500, 2])
def test_jaccard_id_with_several_texts(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    text = lambda c, last="": " ".join(f"{c}{i}" for i in range(30)) + last
    rows = [(1, text("a")), (2, text("b")), (5, text("a", " x")), (5, text("b", " y")), (5, text("b", " y"))]
    rows += [(11, text("c")), (12, text("d")), (13, text("c")), (13, text("d", " z")), (13, text("alone"))]
    # Each of an id's texts has its links, also where another of its texts is a copy.
    rows += [(21, text("e")), (21, text("f")), (22, text("e", " x")), (23, text("f", " x")), (30, text("g")), (31, text("g")), (31, text("h")), (33, text("h", " x"))]
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    least = {1: 1, 2: 1, 5: 1, 11: 11, 12: 11, 13: 11, 21: 21, 22: 21, 23: 21, 30: 30, 31: 30, 33: 30}
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, least[i]) for i, _ in rows)


def test_connect_takes_known_links():
    sets = [np.arange(a, a + 20, dtype=np.uint64) for a in (0, 1, 100, 101, 200)]
    assert jaccard_join.connect(sets, 80).tolist() == [0, 0, 2, 2, 4]
    assert jaccard_join.connect(sets, 80, found=[7, 8, 7, 8, 9]).tolist() == [0, 0, 0, 0, 4]
    assert jaccard_join.connect(sets, 80, [False, False, True, False, False]).tolist() == [0, 1, 2, 2, 4]


def test_notices_that_share_a_sentence(spark, monkeypatch):
    """A group whose documents link with none stays in blocks of bounded size."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    sizes, searched = [], jaccard_join._searched
    largest = lambda rows: rows.groupBy("block").agg(F.count_distinct("doc_id", "mark").alias("n")).agg(F.max("n")).first()[0]
    monkeypatch.setattr(jaccard_join, "_searched", lambda rows, *a: sizes.append(largest(rows)) or searched(rows, *a))
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, f"n{i} o{i} p{i % 50} q{i % 7} r{i} {shared} t{i % 11} u{i % 13} v{i % 17} w{i} x{i}") for i in range(600)]
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows)
    assert 10 < max(sizes) <= 3 * 40 + 2 * jaccard_join.PIVOTS


def test_t_occurrence_counts_all():
    r = random.Random(3)
    for _ in range(300):
        lists = [sorted(r.sample(range(30), r.randrange(0, 25))) for _ in range(r.randrange(1, 12))]
        least = r.randrange(1, len(lists) + 1)
        count = {m: sum(m in x for x in lists) for m in range(30)}
        want = {m: n for m, n in count.items() if n >= least}
        assert jaccard_join.t_occurrence(lists, least) == want
        assert jaccard_join.merge_skip(lists, least) == want


@pytest.mark.parametrize("few", [components.FEW, 10])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    r = random.Random(6)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 380)] + [(5, None)]
    up = {}
    for a, b in edges:
        if b is not None and a != b:
            ra, rb = up.setdefault(a, a), up.setdefault(b, b)
            for k in [k for k, v in up.items() if v in (ra, rb)]:
                up[k] = min(ra, rb)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == up


def test_few_edges_take_no_rounds(spark, monkeypatch):
    tables, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or written(df, name))
    chain = spark.range(64).selectExpr("id as u", "id + 1 as v")
    assert {(x.node, x.component) for x in components.components(chain).collect()} == {(i, 0) for i in range(65)}
    assert len(tables) == 2


@pytest.mark.parametrize("bits", [bitmap.NATIVE, 8])
def test_without_keys(spark, monkeypatch, bits):
    monkeypatch.setattr(bitmap, "NATIVE", bits)
    rows = spark.range(300).selectExpr("id as a", "id % 7 as b", "array(id) as wide")
    for gone in (set(), set(range(0, 300, 3)), {299}):
        side = rows.select("a", "b").where(rows["a"].isin(gone)) if gone else rows.select("a", "b").limit(0)
        got = bitmap.without(rows, rows.select("a", "b"), side, ["a", "b"])
        assert got.columns == rows.columns and sorted(r.a for r in got.collect()) == [i for i in range(300) if i not in gone]


def test_hash_lists_and_texts_outside_groups_are_not_shuffled(spark, monkeypatch):
    """Also with more copies and groups than a broadcast takes."""
    monkeypatch.setattr(jaccard_join, "checked", lambda side, *a: side.hint("merge"))
    plans, groups = [], jaccard_join._groups
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(jaccard_join, "_groups", lambda spark, least, *a: plans.append(plan(least)) or groups(spark, least, *a))
    rows = [(i, " ".join(f"w{i % 40}x{k}" for k in range(20))) for i in range(200)]
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i % 40) for i in range(200)]
    assert "hashpartitioning" not in plans[0]


def test_large_groups_are_divided_and_searched_in_waves(spark, monkeypatch):
    """Of chance groups nothing reaches the search, and pairs of blocks are not shuffled all at once."""
    for name, value in (("BLOCK", 5), ("PIVOTS", 1), ("WAVE", 1)):
        monkeypatch.setattr(jaccard_join, name, value, raising=False)
    counts, searched = [], jaccard_join._searched
    monkeypatch.setattr(jaccard_join, "_searched", lambda rows, *a: counts.append(rows.count()) or searched(rows, *a))
    r = np.random.default_rng(1)
    rows, sets = [], {}
    for group in range(3):
        core = r.integers(0, 1 << 62, 60)
        for i in range(40):
            shared, own = ((core[i % 30 : i % 30 + 2], 60), (core[:36], 12 + i % 3), (core, i % 20))[group]
            s = np.unique(np.concatenate([shared, r.integers(0, 1 << 62, own)]).astype(np.uint64))
            sets[100 * group + i] = s
            rows.append((100 * group + i, 100 * group + i, len(s), group, bytearray(s.tobytes())))
    table = jaccard_join.written(spark.createDataFrame(rows, "doc_id long, mark long, n long, component long, tokens binary"), "sets")
    edges = [tuple(e) for part in jaccard_join._links(table, 80) for e in part.collect()]
    where = {d: i for i, d in enumerate(sets)}
    best = jaccard_join.connect(list(sets.values()), 80)
    nodes, least = components.least_reached(*np.array(edges).T)
    got = dict(zip(nodes.tolist(), least.tolist()))
    assert [where[got.get(d, d)] for d in sets] == best.tolist()
    assert counts[0] < 60 and len(counts) > 2
