import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from folioforge.llm import packing, token_files, tokens
from folioforge.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def enc():
    return Encoder(PATH)


def library(enc, text):
    return np.array(enc.library.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_short_way_equals_library(enc):
    r = random.Random(1)
    letters = "abcXYZ'ldmsrtve09²¼ \t\n\x0b\x0c\r\x85\xa0éÉñßÿŸœŒİıſƀ\x1cªº-!?.,|<>́中文😀"
    for i in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(40))) + "<|endoftext|>x" * (i % 50 == 0)
        assert enc.encode(text) == library(enc, text).tobytes()


def test_frequent_words_outlive_rare_ones(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 40_000)
    own, made = Encoder(PATH), []
    make = own.words.make
    own.words.make = lambda w: made.append(w) or make(w)
    for i in range(3000):
        text = f"often Once{i:x}z"
        assert own.encode(text) == library(own, text).tobytes()
    assert made.count("often") == 1
    # Memory stays bounded: rare words are made again.
    assert len(own.words) + len(own.words.old) < 500


def test_coding_round_trip():
    r = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (2.0 ** r.uniform(0, 32, n)).astype(np.uint64).clip(0, 2**32 - 1).astype("<u4")
        assert (token_files.unpack(*token_files.pack(ranks), n) == ranks).all()


def test_file_round_trip():
    r = np.random.default_rng(3)
    parts = [r.integers(0, 70_000, n).astype("<u4") for n in (5, 0, 1, 2_000_000, 7, 300)]
    ids = [3, 4, None, 9, 9, -1]
    raw = token_files.dump(ids, [p.tobytes() for p in parts], 70_000)
    back = list(token_files.load(raw))
    assert [d for d, _ in back] == ids
    assert all((a == b).all() for (_, a), b in zip(back, parts))
    assert list(token_files.load(token_files.dump([], [], 10))) == []


ROWS = [(5, "Hello there, World's end", 1), (2, None, 2), (None, "x y", 3), (9, "word " * 9000, 4), (5, "", 5), (7, "été 中文", 6)]


def test_token_table(spark, enc):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start int")
    got = [tuple(r) for r in token_files.token_table(docs, PATH, with_ids=True).collect()]
    at, seen = 0, []
    for doc, start, n, crc, ids in sorted(got, key=lambda r: r[1]):
        assert start == at and n == len(ids) // 4 and crc == zlib.crc32(ids)
        at += n
        seen.append((doc, bytes(ids)))
    want = [(d, library(enc, t).tobytes() + b"\2\0\0\0") for d, t, _ in ROWS]
    assert sorted(seen, key=str) == sorted(want, key=str)
    assert [d for d, _ in seen] == [None, 2, 5, 5, 7, 9]
    assert token_files.token_table(docs.limit(0), PATH).count() == 0


def test_packing(spark, enc):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, length int")
    rows = packing.pack_documents(docs, PATH, window=64, with_ids=True).collect()
    fill = {}
    for r in rows:
        assert 0 < r.length <= 64 and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    long = b"".join(bytes(r.ids) for r in sorted((r for r in rows if r.doc_id == 9), key=lambda r: r.start))
    assert long == library(enc, ROWS[3][1]).tobytes() + b"\2\0\0\0"
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_best_fit_is_the_tightest():
    r = random.Random(4)
    lengths = [r.randrange(1, 101) for _ in range(400)]
    got = packing.best_fit(lengths, 100)
    room = []
    for i in sorted(range(400), key=lambda i: (-lengths[i], i)):
        fits = [(x, w) for w, x in enumerate(room) if x >= lengths[i]]
        window, offset = got[i]
        if fits:
            assert 100 - offset == min(fits)[0] == room[window]
        else:
            assert offset == 0 and window == len(room)
            room.append(100)
        room[window] -= lengths[i]
