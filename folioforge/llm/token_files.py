"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Format of a file (little-endian):
    magic "FFT1", u32 vocabulary size V, u64 documents D, u64 ids N
    V x u32   id of each rank, most frequent first, counted over the file
    D x i64   doc ids, D x u8 whether the doc id is null, D x u64 ids of each document
    ceil(N/4) control bytes: two bits for each id, its rank's bytes less one
    data bytes: the ranks, 1 to 4 bytes each
A reader finds every rank's place from the control bytes by a 256-row table of lengths and a running sum.

Documents are range-partitioned by id, so that files follow each other in ascending order; each task writes
its files through the shared store, closing one when it holds `most_ids`, which bounds memory. Only files named
in the manifest count, so what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.shared import batches, shared_dir, written
from folioforge.llm.tokens import encoder

MAGIC = b"FFT1"
#: Lengths of the four ranks that a control byte describes.
LENGTHS = np.array([[(b >> 2 * i & 3) + 1 for i in range(4)] for b in range(256)], np.uint8)
MANIFEST = "part int, seq int, path string, first_doc long, n_docs long, n_ids long"


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4", copy=False)
    size = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    keep = np.arange(4, dtype=np.uint8) < size[:, None]
    return control, ranks.view(np.uint8).reshape(-1, 4)[keep]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n ranks that pack() was given, by table lookup."""
    size = LENGTHS[control].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    out = data[start].astype(np.uint32)
    for i in range(1, 4):
        there = np.flatnonzero(size > i)
        if not len(there):
            break
        out[there] |= data[start[there] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def dump(ids: list, parts: list[bytes], n_vocabulary: int) -> bytes:
    """A file's bytes for doc ids (None: null) and each document's ids as little-endian u32 bytes."""
    counts = np.array([len(p) // 4 for p in parts], "<u8")
    flat = np.frombuffer(b"".join(parts), "<u4")
    size = max(n_vocabulary, int(flat.max()) + 1 if len(flat) else 0)
    by_rank = np.argsort(-np.bincount(flat, minlength=size), kind="stable").astype("<u4")
    rank = np.empty(size, "<u4")
    rank[by_rank] = np.arange(size, dtype="<u4")
    control, data = pack(rank[flat])
    null = np.array([x is None for x in ids], np.uint8)
    doc = np.array([x or 0 for x in ids], "<i8")
    head = MAGIC + np.uint32(size).tobytes() + np.array([len(ids), len(flat)], "<u8").tobytes()
    return b"".join([head, by_rank.tobytes(), doc.tobytes(), null.tobytes(), counts.tobytes(), control.tobytes(), data.tobytes()])


def load(raw: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc id, ids as u32) of each document of a file, in its order."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token file")
    size = int(np.frombuffer(raw, "<u4", 1, 4)[0])
    n_docs, n = map(int, np.frombuffer(raw, "<u8", 2, 8))
    at = 24
    by_rank = np.frombuffer(raw, "<u4", size, at)
    at += 4 * size
    doc = np.frombuffer(raw, "<i8", n_docs, at)
    at += 8 * n_docs
    null = np.frombuffer(raw, np.uint8, n_docs, at)
    at += n_docs
    counts = np.frombuffer(raw, "<u8", n_docs, at).astype(np.int64)
    at += 8 * n_docs
    control = np.frombuffer(raw, np.uint8, -(-n // 4), at)
    data = np.frombuffer(raw, np.uint8, -1, at + len(control)) if at + len(control) < len(raw) else np.zeros(0, np.uint8)
    # A stretch of documents at a time: the decoder's tables need some 30 bytes an id.
    ends = np.cumsum(counts)
    done = used = i = 0
    while i < n_docs:
        j = max(i + 1, int(np.searchsorted(ends, done + (1 << 20), "right")))
        first, last = done // 4, -(-int(ends[j - 1]) // 4)
        skip = done - 4 * first
        size = LENGTHS[control[first:last]].reshape(-1)[: int(ends[j - 1]) - 4 * first]
        used -= int(size[:skip].sum())
        flat = by_rank[unpack(control[first:last], data[used:], len(size))][skip:]
        used += int(size.sum())
        done = int(ends[j - 1])
        for k, ids in zip(range(i, j), np.split(flat, np.cumsum(counts[i:j])[:-1])):
            yield (None if null[k] else int(doc[k])), ids
        i = j


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, tokenizer: str, uri: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", most_ids: int = 4 << 20) -> DataFrame:
    """Writes files below uri in ascending id order and returns their manifest, one row per file.

    Null texts are empty (their end id remains), null ids come first, rows that repeat an id lie next to each
    other. Other columns are ignored. An empty input writes no file.
    """
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(it):
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        store, folder = _store(uri)
        ids, parts, held = [], [], 0

        def close():
            path = f"{folder}/tokens-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.fft"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(path) as f:
                f.write(dump(ids, parts, enc.n_ids))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([part, seq, path.rpartition("/")[2], ids[0], len(ids), held], schema.types)], schema=schema)

        for batch in batches(it):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                code = enc.encode(text.as_py() or "") + tail
                ids.append(doc)
                parts.append(code)
                held += len(code) // 4
                if held >= most_ids:
                    yield close()
                    ids, parts, held, seq = [], [], 0, seq + 1
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(write, MANIFEST)


def read_tokens(spark: SparkSession, manifest: DataFrame, uri: str, with_ids: bool = False) -> DataFrame:
    """Documents of the manifest's files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (u32 bytes).

    start counts the ids of all documents before it. The running sum over files has one row per file.
    """
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).select("path", "base")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def read(it):
        store, folder = _store(uri)
        for batch in it:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{folder}/{path}") as f:
                    raw = f.read()
                out, held = [], 0
                for doc, ids in load(raw):
                    code = ids.astype("<u4").tobytes()
                    out.append((doc, base, len(ids), zlib.crc32(code)) + (code,) * with_ids)
                    base += len(ids)
                    held += len(code) if with_ids else 64
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    n = max(1, manifest.count())
    spread = files.repartition(min(n, 4 * spark.sparkContext.defaultParallelism), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def token_table(docs: DataFrame, tokenizer: str, end_id: int | None = 2, with_ids: bool = False, **columns) -> DataFrame:
    """write_tokens to a new shared folder, then read_tokens from it."""
    spark = docs.sparkSession
    uri = shared_dir(spark, "tokens")
    manifest = written(write_tokens(docs, tokenizer, uri, end_id, **columns), "token-manifest")
    return read_tokens(spark, manifest, uri, with_ids)
