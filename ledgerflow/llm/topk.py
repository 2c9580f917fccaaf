"""Exact top-k inner products by Fagin's threshold algorithm.

Every component becomes floor(256 * x). Vectors are packed into blocks; a block keeps one
list per dimension, its rows sorted by that component. For a query the lists are read in
step from their better end (the high end for positive query components, the low end for
negative ones), in strides that double. Rows met for the first time are scored in full. The bound is
the query's product with the components last read: no unread row can score more. Reading
stops when the bound is below the k-th best score (strictly, so ties go to the smaller
vec_id whatever the order of reading) or every row has been met. The k-th score that a query
has from a task's earlier blocks is carried on: a block whose largest components
cannot reach it is not read at all, others stop as soon as their bound is below it.

Query chunks meet every block by a join on a group number of the blocks, not through the
driver; a group has about ``TOGETHER`` blocks, so a chunk is copied once for so many. Each
block gives at most k rows a query, merged by a window. Of equal vectors in
a block only the k + 1 smallest ids can appear in an answer, so copies beyond are left out.

Cases: vectors null or with null or non-finite components, and null ids, take no part;
only vectors of equal length meet; a query's own vec_id is never its answer; rows with a
repeated vec_id are candidates each, and repeated query ids answer together. Scores are
exact below 2**53. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
CHUNK = 512
#: Blocks of a group, and query chunks whose k-th scores a task holds; a forgotten one costs reading only.
TOGETHER, HELD = 4, 2000
_PACKED = "dim int, ids binary, vectors binary"
_ANSWER = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors with components floor(256 * x)."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ok)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v")))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of at most ``size`` vectors of equal length, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, vs = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(vs, np.float64).tobytes()], pa.binary())], ["dim", "ids", "vectors"])

        for b in batches:
            v = b.column("v")
            flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            for k, i in enumerate(b.column("vec_id").to_pylist()):
                x = flat[at[k]: at[k + 1]]
                held.setdefault(len(x), []).append((i, x))
                if len(held[len(x)]) == size:
                    yield out(len(x))
        for dim in sorted(held):
            yield out(dim)

    return rows.mapInArrow(pack, _PACKED)


class Block:
    """Vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        # of equal vectors, the k + 1 smallest ids
        _, same = np.unique(vectors, axis=0, return_inverse=True)
        by = np.lexsort((ids, same.ravel()))
        group = same.ravel()[by]
        first = np.searchsorted(group, group, "left")
        keep = by[np.arange(len(by)) - first <= k]
        keep = keep[np.argsort(ids[keep], kind="stable")]
        self.ids, self.v = ids[keep], vectors[keep]
        self.order = np.argsort(self.v, axis=0, kind="stable")
        self.least, self.most = self.v.min(axis=0), self.v.max(axis=0)
        self.met = 0  # rows scored so far

    def top(self, q: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the k best rows for ``q``, ties to the smaller id; of rows that
        score less than ``floor`` some may be missing."""
        n = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        met = np.zeros(n, bool)
        best, score = np.zeros(0, np.int64), np.zeros(0)
        depth, stride = 0, 16
        if not len(up) and not len(down):
            best = np.flatnonzero(self.ids != own)[:k]
            return self.ids[best], np.zeros(len(best))
        if self.most[up] @ q[up] + self.least[down] @ q[down] < floor:
            return best, score
        while depth < n:
            to = min(n, depth + stride)
            now = np.zeros(n, bool)
            now[self.order[n - to: n - depth, up]] = True
            now[self.order[depth:to, down]] = True
            now &= ~met
            met |= now
            new = np.flatnonzero(now & (self.ids != own))
            self.met += len(new)
            best, score = np.concatenate([best, new]), np.concatenate([score, self.v[new] @ q])
            if len(best) > k:
                top = np.lexsort((best, -score))[:k]
                best, score = best[top], score[top]
            bound = self.v[self.order[n - to, up], up] @ q[up] + self.v[self.order[to - 1, down], down] @ q[down]
            if bound < max(floor, score.min() if len(best) == k else -np.inf) or met.all():
                break
            depth, stride = to, stride * 2
        return self.ids[best], score


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row that ``is_query`` marks."""
    rows = quantised(vectors)
    groups = 1 + vectors.count() // (BLOCK * TOGETHER)
    blocks = packed(rows, BLOCK).withColumn("grp", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    # numbered, so that equal chunks of repeated rows are not taken for one another
    chunks = (packed(rows.where(is_query), CHUNK).withColumn("chunk", F.monotonically_increasing_id())
              .select("chunk", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                      F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        scores: dict[int, np.ndarray] = {}  # of each query of a chunk, the k best so far
        for b in batches:
            for dim, ids, vs, chunk, q_ids, q_vs in zip(*[b.column(c).to_pylist() for c in
                                                   ("dim", "ids", "vectors", "chunk", "q_ids", "q_vectors")]):
                if ids != last:
                    last, block = ids, Block(np.frombuffer(ids, np.int64), np.frombuffer(vs, np.float64).reshape(-1, dim), k)
                own = np.frombuffer(q_ids, np.int64)
                best = scores.pop(chunk, None)
                if best is None:
                    best = np.full((len(own), k), -np.inf)
                    if len(scores) >= HELD:
                        scores.pop(next(iter(scores)))
                found = [(i, *block.top(q, i, k, floor)) for i, q, floor in
                         zip(own.tolist(), np.frombuffer(q_vs, np.float64).reshape(len(own), dim), best[:, 0].tolist())]
                for at, (_, _, new) in enumerate(found):
                    best[at] = np.sort(np.concatenate([best[at], new]))[-k:]
                scores[chunk] = best
                n = [len(x) for _, x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([i for i, _, _ in found], n).astype(np.int64)),
                     pa.array(np.concatenate([x for _, x, _ in found])),
                     pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64))], ["query_id", "vec_id", "score"])

    found = blocks.join(chunks, ["grp", "dim"]).mapInArrow(search, _ANSWER)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
