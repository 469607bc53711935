"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every vector is assigned to a leaf where it is read. A query walks the
tree through a priority queue of bins by their centre's distance, and keeps taking leaves until it has seen as
many as the calibration asks for: a bounded set of sample queries is first searched by brute force over all
vectors, and the visits are widened until the leaves taken hold the wanted share of their true neighbours.

Queries meet a leaf's vectors in slices of bounded size, so a leaf that holds a third of all rows is spread over
many tasks; each slice returns its own nearest few for each query, and these are ranked per query.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.shared import written

#: Vectors that the tree is fitted on, in expectation; children of a node; sample vectors in a leaf.
SAMPLE, BRANCH, LEAF = 20_000, 8, 64
#: Calibrating queries; share of their true neighbours that the visits must hold; rows in a slice of a leaf.
PROBES, RECALL, SLICE = 96, 0.97, 4096
SEED = 5


def _distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distance in double precision, by differences: equal vectors give equal results."""
    return np.sqrt(((rows - to) ** 2).sum(axis=1))


class Tree:
    """Nodes in arrays: centre, children (a range of node numbers, empty for a leaf), leaf number."""

    def __init__(self, sample: np.ndarray):
        self.key = uuid.uuid4().hex
        rng = np.random.default_rng(SEED)
        self.centres, self.first, self.last, self.leaf = [sample.mean(axis=0)], [0], [0], [-1]
        todo, self.leaves = [(0, np.arange(len(sample)))], 0
        while todo:
            node, own = todo.pop()
            parts = self._split(sample, own, rng) if len(own) > LEAF else []
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            self.first[node], self.last[node] = len(self.centres), len(self.centres) + len(parts)
            for p in parts:
                todo.append((len(self.centres), p))
                self.centres.append(sample[p].mean(axis=0))
                self.first.append(0), self.last.append(0), self.leaf.append(-1)
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(sample, own, rng) -> list[np.ndarray]:
        rows = sample[own]
        centres = rows[rng.choice(len(rows), min(BRANCH, len(rows)), replace=False)]
        for _ in range(8):
            near = ((rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)).argmin(axis=1)
            centres = np.array([rows[near == c].mean(axis=0) for c in np.unique(near)])
        near = ((rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)).argmin(axis=1)
        return [own[near == c] for c in np.unique(near)]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to, always to the nearest child."""
        at = np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1)
        todo = {0: np.arange(len(rows))}
        while todo:
            node, own = todo.popitem()
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
                continue
            a, b = self.first[node], self.last[node]
            near = np.stack([_distances(rows[own], c) for c in self.centres[a:b]]).argmin(axis=0)
            for c in np.unique(near):
                todo[a + int(c)] = own[near == c]
        return out if len(at) else at

    def bins(self, query: np.ndarray):
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
                continue
            a, b = self.first[node], self.last[node]
            for c, d in zip(range(a, b), _distances(self.centres[a:b], query).tolist()):
                heapq.heappush(queue, (d, c))


def usable(vector: Column, dims: int) -> Column:
    """True for vectors of that length, all finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    """Rows of a list column without nulls, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _nearest(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, k: int):
    """The k nearest of rows to the query, its own id left out, nearest first, ties to the smaller id."""
    d = _distances(rows, query)
    d[ids == query_id] = np.inf
    if len(d) > 4 * k:
        some = np.flatnonzero(d <= np.partition(d, k)[k])
    else:
        some = np.arange(len(d))
    some = some[np.lexsort((ids[some], d[some]))][:k]
    return [(int(ids[i]), float(d[i])) for i in some if np.isfinite(d[i])]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
FOUND_SQL = "query_id long, vec_id long, score double"


def build(vectors: DataFrame, id_col: str, vector_col: str, k: int, recall: float):
    """(index table of vec_id, v, leaf; tree; rows in each leaf; leaves to visit), or None if no vector is usable."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null")
    dims = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return None
    rows = rows.where(usable(F.col("v"), dims["d"]))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(part < min(1.0, SAMPLE / max(1, dims["count"]))).orderBy("vec_id").limit(2 * SAMPLE).collect()
    if not sample:
        sample = rows.limit(1).collect()
        if not sample:
            return None
    fitted = np.array([r["v"] for r in sample])
    tree = spark.sparkContext.broadcast(Tree(fitted))

    def assign(it):
        for b in it:
            leaf = tree.value.assign(_matrix(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf, pa.int64())], names=["vec_id", "v", "leaf"])

    index = written(rows.mapInArrow(assign, "vec_id long, v array<double>, leaf long"), "vectors")
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}

    picked = [sample[i] for i in np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int)]
    asked = spark.sparkContext.broadcast([(r["vec_id"], np.array(r["v"])) for r in picked])
    probe = pa.schema([*FOUND, ("leaf", pa.int64())])

    def brute(it):
        for b in it:
            ids, own, leaf = b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
            where = dict(zip(ids.tolist(), leaf.tolist()))
            got = [(q, i, s, where[i]) for q, v in asked.value for i, s in _nearest(ids, own, q, v, k)] if len(ids) else []
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), probe.types)], schema=probe)

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = index.mapInArrow(brute, FOUND_SQL + ", leaf long").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).collect()
    turn = {q: {leaf: n for n, leaf in enumerate(tree.value.bins(v))} for q, v in asked.value}
    turns = sorted(turn[r["query_id"]][r["leaf"]] + 1 for r in true)
    visits = turns[min(len(turns) - 1, int(np.ceil(recall * len(turns))) - 1)] if turns else 1
    return index, tree, sizes, visits


def search(vectors: DataFrame, is_query: Column, k: int = 10, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k nearest found: query_id, rank (from 1), vec_id, score (Euclidean distance, double precision).

    Queries are the rows that is_query (over vec_id) marks, candidates all rows but those of the query's id.
    Vectors that are null, zero, of another length than most, or hold null or non-finite components, and rows
    with a null id, take no part. Nearest first, ties to the smaller id; all candidates if they are fewer. A
    query goes on past the calibrated visits until its leaves hold k others. Rows that repeat an id count each.
    """
    spark = vectors.sparkSession
    made = build(vectors, id_col, vector_col, k, recall)
    if made is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, tree, sizes, visits = made
    slices = {leaf: -(-n // SLICE) for leaf, n in sizes.items()}
    cuts = spark.createDataFrame(list(slices.items()), "leaf long, cuts long")  # one row per leaf

    def probe(it):
        for b in it:
            out = []
            for q, v in zip(b.column(0).to_pylist(), _matrix(b.column(1))):
                seen, held = 0, 0
                for leaf in tree.value.bins(v):
                    if seen >= visits and held > k:
                        break
                    seen, held = seen + 1, held + sizes.get(leaf, 0)
                    out += [(q, v.tolist(), leaf, s) for s in range(slices.get(leaf, 0))]
            for at in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 2000]), [pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.int32()])], names=["id", "v", "leaf", "slice"])

    queries = index.where(is_query).select("vec_id", "v").mapInArrow(probe, "id long, v array<double>, leaf long, slice int")
    rows = index.join(F.broadcast(cuts), "leaf").select(F.col("vec_id").alias("id"), "v", "leaf", F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int").alias("slice"))
    both = rows.withColumn("asks", F.lit(0)).unionByName(queries.withColumn("asks", F.lit(1)))
    both = both.repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", "asks", "id")

    def meet(it):
        own, ids, held, names = None, [], [], []
        for b in it:
            v = _matrix(b.column(1))
            out = []
            for n, (i, leaf, cut, asks) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 2, 3, 4)))):
                if own != (leaf, cut):
                    own, names, held, ids = (leaf, cut), [], [], None
                if not asks:
                    names.append(i)
                    held.append(v[n])
                    continue
                if not names:
                    continue
                if ids is None:
                    ids, rows = np.array(names), np.array(held)
                out += [(i, *x) for x in _nearest(ids, rows, i, v[n], k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), FOUND.types)], schema=FOUND)

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = both.mapInArrow(meet, FOUND_SQL).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
