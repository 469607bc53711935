"""Exact, memoised encoding with a public tokenizer file.

A tokenizer whose text is cut at white space and into runs of letters, single digits and other marks encodes
each such piece by itself, so a piece's ids can be remembered. Texts of Latin letters take that way: words are
looked up, unknown ones are cut into pieces, unknown pieces go to the library's model. A piece is a word too, so
that one memo holds both. Any other text, and any tokenizer of another make, goes to the library whole. Both ways
give the library's ids.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np

from folioforge.llm.words import ENTRY, MEMO, hold

#: The split pattern that allows the short way, and the normalizers that go with it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: The same pattern for lower-cased text up to U+017F, and what takes the long way: characters beyond that,
#: separators on which libraries differ, a capital that lower-cases to two characters, marks of special tokens.
LATIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿĀ-ſ]+|[0-9²³¹¼½¾]|[^\t\n\v\f\r \x85\xa0a-zªµºß-öø-ÿĀ-ſ0-9²³¹¼½¾]+")
OTHER = re.compile(r"[İƀ-\U0010ffff]")
MARKS = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def takes_long_way(text: str) -> bool:
    """By plain searches where they do: most texts are Latin-1, and a pattern looks at each character."""
    if any(map(text.__contains__, MARKS)):
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return OTHER.search(text) is not None
    return False


def byte_letters() -> dict[int, str]:
    """Byte-level spelling of the characters up to U+017F: printable bytes stand for themselves, others for U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    spelt = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(0x180)}


class _Memo(dict):
    """Values made once, in two generations of MEMO bytes as estimated: what is asked for again outlives the rest."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.empty()

    def empty(self):
        self.clear()
        self.old, self.bytes = {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if self.bytes > MEMO:
            self.old, self.bytes = self.copy(), 0
            self.clear()
        self[key] = value
        self.bytes += len(key) + len(value) + ENTRY
        return value


class Encoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.n_ids = self.library.get_vocab_size(with_added_tokens=True)
        norm = [x.get("type") for x in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.short = norm == NORMALIZERS and len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": PATTERN} and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and all("<|" in x["content"] for x in made["added_tokens"])
        self.letters = byte_letters()
        self.words = _Memo(self._made)
        self.get, self.tokenize = self.words.__getitem__, self.library.model.tokenize

    def _made(self, word: str) -> bytes:
        pieces = LATIN.findall(word)
        if len(pieces) != 1:
            return b"".join(map(self.get, pieces))
        ids = [t.id for t in self.tokenize(word if word.isascii() and word.isalpha() else pieces[0].translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def empty(self) -> None:
        """Called when another operator takes over: the tokenizer goes too, once its task has ended."""
        self.words.empty()
        encoder.cache_clear()

    def encode(self, text: str) -> bytes:
        hold(self)
        if self.short and not takes_long_way(text):
            return b"".join(map(self.get, text.lower().split()))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, its memos kept from task to task."""
    return Encoder(path)
