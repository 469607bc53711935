"""Packing token sequences into fixed windows by best-fit decreasing.

Documents longer than a window are cut into full windows first. The rest are placed by decreasing length, each
into the open window that it fits most tightly; a segment tree over remaining capacity finds that window in
O(log capacity). Every task packs what it reads, in rounds of bounded size, so nothing is shuffled and no task
grows with the input; the price is at most a few part-filled windows for each round.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import batches
from folioforge.llm.tokens import encoder

COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Windows by remaining capacity: a segment tree counts them, so the tightest fit is found from the root."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def add(self, room: int, window: int) -> None:
        if room > 0:
            self.at.setdefault(room, []).append(window)
            node = room + self.leaves
            while node:
                self.count[node] += 1
                node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """(window, its room) with the least room of at least length, taken out; None if there is none."""
        node, count = length + self.leaves, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.at[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) of each length, none of which exceeds capacity; windows are numbered from 0."""
    out, windows, n = [(0, 0)] * len(lengths), OpenWindows(capacity), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = windows.tightest(lengths[i])
        if found is None:
            found, n = (n, capacity), n + 1
        window, room = found
        out[i] = (window, capacity - room)
        windows.add(room - lengths[i], window)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int | None = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", round_pieces: int = 1 << 17) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids.

    Null texts are empty (their end id is packed), rows that repeat an id are packed each for itself, null ids
    stay null. Other columns are ignored. With ids (u32 bytes) rounds are also bounded by their bytes.
    """
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    types = [pa.int64()] * 7 + [pa.binary()] * with_ids
    names = [c.split()[0] for c in COLUMNS.split(", ")] + ["ids"] * with_ids

    def run(it):
        enc, base = encoder(tokenizer), TaskContext.get().partitionId() << 32
        pieces, held = [], 0

        def close():
            nonlocal base
            placed = best_fit([p[2] for p in pieces], window)
            rows = [(*p[:5], base + w, at, *p[5:]) for p, (w, at) in zip(pieces, placed)]
            base += 1 + max(w for w, _ in placed)
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 10_000]), types)], names=names)

        for batch in batches(it):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                code = enc.encode(text.as_py() or "") + tail
                n = len(code) // 4
                for start in range(0, n, window):
                    ids = code[4 * start : 4 * (start + window)]
                    pieces.append((doc, start, len(ids) // 4, zlib.crc32(ids), n) + (ids,) * with_ids)
                    held += len(ids) * with_ids
                if len(pieces) >= round_pieces or held > 256 << 20:
                    yield from close()
                    pieces, held = [], 0
        if pieces:
            yield from close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, COLUMNS + ", ids binary" * with_ids)
