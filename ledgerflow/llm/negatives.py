"""Hard negatives by cover trees over norm-augmented candidates.

Every component becomes floor(256 * x); scores are integer inner products. An anchor's positives
are its best rows of the same label; for each positive the best rows of other labels
whose score lies in a window of the positive's score are returned.

* Blocks. Rows go into blocks of at most ``BLOCK``, in order of label, so that most blocks hold one
  label. Of rows with equal label and vector only the smallest ids that an answer can name
  are kept.
* Cover tree. Within a block a component sqrt(M^2 - |x|^2), M the block's largest norm, puts all rows
  on one sphere, where the inner product with a query is the cosine of an angle. A node
  has a centre, a row, and covers its rows within an angle; its children, one of them with the
  same centre, are picked greedily so that they lie further apart than the next level's
  angle and cover every row within it. Levels shrink by ``SHRINK``; a node of ``LEAF`` rows or
  fewer is a leaf. Each node keeps its labels (if one) and its exact covering radius.
* Descent. The angle between query and centre, less or plus the covering radius, bounds the inner
  products of all of a node's rows. Queries go down a tree together, level by level, each with
  its own open nodes: nodes whose bounds lie outside the window, or below the worst of the k
  rows found, or whose rows have the wrong label, are skipped whole; the rows of the leaves
  reached are scored exactly.

Query chunks meet the blocks by a join, not through the driver, copied once for each group
of blocks; each block gives at most k rows a window, and what a query has found in earlier
blocks of the task bounds the next ones. On vectors without structure bounds in high
dimension are wide, and the descent reads most leaves; the answer is exact either way.

Cases: rows with a null label, vector or id, or a null or non-finite component, take no part;
only vectors of equal length meet; a row is never the partner of a row with its own vec_id;
a row repeated whole counts once, rows that share a vec_id and differ are candidates each,
and anchors that share one answer each for itself; ties go to the smaller vec_id. A positive score
below zero has an empty window. Vectors without components score 0. Scores are exact below 2**53.
Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut

BLOCK, CHUNK, LEAF, SHRINK = 2048, 1024, 48, 1.4
#: Queries of a chunk that go down a tree together.
STRIP = 128
#: Trees and bounds that a task keeps at hand; losing one costs time only.
TREES, HELD = 8, 200_000
_PACKED = "grp int, dim int, ids binary, labels binary, vectors binary"
_NO_LABEL = -(2 ** 63)


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, v): different usable rows with components floor(256 * x)."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ok)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
            .where(F.col("label").isNotNull()).distinct())


class CoverTree:
    """A cover tree over the norm-augmented rows of a block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, vectors
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.top = float(norms.max(initial=0.0)) or 1.0
        augmented = np.column_stack([vectors, np.sqrt(np.maximum(0.0, self.top ** 2 - norms ** 2))]) / self.top
        angle = np.arccos(np.clip(augmented @ augmented.T, -1.0, 1.0))
        self.centre, self.radius, self.label = [], [], []
        self.children: list[np.ndarray | None] = []
        self.rows: list[np.ndarray | None] = []
        work = [(self._node(angle, 0, np.arange(len(ids))), np.pi)]
        while work:
            node, reach = work.pop()
            mine = self.rows[node]
            if len(mine) <= LEAF or self.radius[node] == 0.0:
                continue
            # the next level that tells some of the rows apart
            reach = min(reach, self.radius[node]) / SHRINK
            parts, left, centre = [], mine, self.centre[node]
            while len(left):
                near = angle[centre, left] <= reach
                near[left == centre] = True
                parts.append((centre, left[near]))
                left = left[~near]
                if len(left):
                    centre = int(left[0])
            self.rows[node] = None
            made = [self._node(angle, c, r) for c, r in parts]
            self.children[node] = np.array(made)
            work += [(c, reach) for c in made]
        self.centre, self.radius, self.label = np.array(self.centre), np.array(self.radius), np.array(self.label, np.int64)
        self.cos, self.sin = np.cos(self.radius), np.sin(self.radius)

    def _node(self, angle: np.ndarray, centre: int, rows: np.ndarray) -> int:
        own = self.labels[rows]
        self.centre.append(centre)
        self.radius.append(float(angle[centre, rows].max()) if len(rows) > 1 else 0.0)
        self.label.append(int(own[0]) if (own == own[0]).all() else _NO_LABEL)
        self.children.append(None)
        self.rows.append(rows)
        return len(self.centre) - 1


class Queries:
    """Queries against one tree, all of them taken down it together."""

    def __init__(self, tree: CoverTree, own: np.ndarray, labels: np.ndarray, q: np.ndarray, same: bool):
        self.tree, self.own, self.labels, self.q, self.same = tree, own, labels, q, same
        self.scale = np.sqrt((q * q).sum(axis=1)) * tree.top
        self.met = np.zeros(len(own), np.int64)

    def _bounds(self, at: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest and the least product that a row of each node can have with each query."""
        t, scale = self.tree, self.scale[at, None]
        cos = np.clip((self.q[at] @ t.v[t.centre[nodes]].T) / np.where(scale > 0, scale, 1.0), -1.0, 1.0)
        sin = np.sqrt(1.0 - cos * cos)
        # cosines of the angle to the centre less and plus the covering radius, from 0 to pi
        near = np.where(cos >= t.cos[nodes], 1.0, cos * t.cos[nodes] + sin * t.sin[nodes])
        far = np.where(cos <= -t.cos[nodes], -1.0, cos * t.cos[nodes] - sin * t.sin[nodes])
        slack = 1e-6 * scale + 1e-6  # far above rounding of the angles
        return scale * near + slack, scale * far - slack

    def _leaves(self, floor: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(queries, leaves, open): the leaves that can add a row to a window (window, query, leaf)."""
        t = self.tree
        at, nodes = np.arange(len(self.own)), np.zeros(1, np.int64)
        open_ = np.ones((len(floor), len(at), 1), bool)
        leaves, reached = [], []
        while len(nodes) and len(at):
            one = t.label[nodes]
            wanted = (one == _NO_LABEL) | ((one == self.labels[at, None]) == self.same)
            up, low = self._bounds(at, nodes)
            open_ &= wanted & (up >= floor[:, at, None]) & (low <= high[:, at, None])
            if nodes[0] == 0:  # queries that the whole block has nothing for
                at, open_ = at[open_.any(axis=(0, 2))], open_[:, open_.any(axis=(0, 2))]
            some = open_.any(axis=(0, 1))
            nodes, open_ = nodes[some], open_[:, :, some]
            leaf = np.array([t.children[n] is None for n in nodes], bool)
            leaves.append(nodes[leaf])
            reached.append(open_[:, :, leaf])
            below = [t.children[n] for n in nodes[~leaf]]
            open_ = np.repeat(open_[:, :, ~leaf], [len(c) for c in below], axis=2)
            nodes = np.concatenate(below) if below else nodes[:0]
        return at, np.concatenate(leaves), np.concatenate(reached, axis=2) if len(at) else open_[:, :, :0]

    def best(self, k: int, low: np.ndarray, high: np.ndarray, scores: np.ndarray, ids: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Merges the tree's rows with scores from ``low`` to ``high`` (window, query) into the k best
        found so far, ``scores`` and ``ids`` (window, query, k), best first, -inf where there are
        fewer. Gives the rows that are among them now: (window, query, score, id)."""
        t = self.tree
        floor = np.maximum(low, scores[:, :, -1])  # one that ties the worst of the k may have a smaller id
        at, leaves, open_ = self._leaves(floor, high)
        none = tuple(np.zeros(0, x) for x in (np.int64, np.int64, np.float64, np.int64))
        if not len(at) or not len(leaves):
            return none
        sizes = np.array([len(t.rows[n]) for n in leaves])
        self.met[at] += open_.any(axis=0) @ sizes
        rows, leaf = np.concatenate([t.rows[n] for n in leaves]), np.repeat(np.arange(len(leaves)), sizes)
        product = self.q[at] @ t.v[rows].T
        usable_ = ((t.labels[rows] == self.labels[at, None]) == self.same) & (t.ids[rows] != self.own[at, None])
        out = []
        for w in range(len(low)):
            ok = open_[w][:, leaf] & usable_ & (product >= floor[w, at, None]) & (product <= high[w, at, None])
            many = np.flatnonzero(ok.sum(axis=1) > k)
            if len(many):
                worst = np.partition(np.where(ok[many], product[many], -np.inf), len(rows) - k, axis=1)[:, len(rows) - k]
                ok[many] &= product[many] >= worst[:, None]
            q, r = np.nonzero(ok)
            if not len(q):
                continue
            hit = np.unique(q)
            held = np.isfinite(scores[w, at[hit]])
            q = np.concatenate([np.repeat(hit, held.sum(axis=1)), q])
            i = np.concatenate([ids[w, at[hit]][held], t.ids[rows[r]]])
            s = np.concatenate([scores[w, at[hit]][held], product[q[len(q) - len(r):], r]])
            fresh = np.arange(len(q)) >= len(q) - len(r)
            by = np.lexsort((i, -s, q))
            q, i, s, fresh = q[by], i[by], s[by], fresh[by]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, i, s, fresh, place = (x[place < k] for x in (q, i, s, fresh, place))
            scores[w, at[q], place], ids[w, at[q], place] = s, i
            out.append((np.full(int(fresh.sum()), w), at[q[fresh]], s[fresh], i[fresh]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else none


class Query:
    """One query against one tree."""

    def __init__(self, tree: CoverTree, own: int, label: int, q: np.ndarray, same: bool):
        self._one = Queries(tree, np.array([own], np.int64), np.array([label], np.int64), q[None], same)

    @property
    def met(self) -> int:
        return int(self._one.met[0])

    def best(self, k: int, low: float, high: float, found: list[tuple[float, int]]) -> list[tuple[float, int]]:
        """``found`` and the tree's rows with scores from ``low`` to ``high``: the k best as (score, -id)."""
        scores, ids = np.full((1, 1, k), -np.inf), np.zeros((1, 1, k), np.int64)
        for x, (s, i) in enumerate(sorted(found, reverse=True)[:k]):
            scores[0, 0, x], ids[0, 0, x] = s, -i
        self._one.best(k, np.array([[low]]), np.array([[high]]), scores, ids)
        return [(s, -i) for s, i in zip(scores[0, 0].tolist(), ids[0, 0].tolist()) if s > -np.inf]


def blocks_of(rows: DataFrame, keep: int) -> DataFrame:
    """The candidates as blocks of at most ``BLOCK`` rows in order of label, in groups."""
    spark = rows.sparkSession
    by_vector = Window.partitionBy("label", "v").orderBy("vec_id")
    few = cut(rows.withColumn("_at", F.row_number().over(by_vector)).where(F.col("_at") <= keep).drop("_at"), "negatives-rows")
    parts = max(1, -(-few.count() // BLOCK))
    groups = min(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.size("v"), F.col("label"), F.xxhash64("v"), F.col("vec_id")]
    dealt = few.withColumn("dim", F.size("v")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            ids = np.array([h[0] for h in held], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([len(held[0][2])], pa.int32()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([np.array([h[1] for h in held], np.int64).tobytes()], pa.binary()),
                 pa.array([np.array([h[2] for h in held], np.float64).tobytes()], pa.binary())],
                ["grp", "dim", "ids", "labels", "vectors"])

        for b in batches:
            v = b.column("v")
            flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            for k, (i, label) in enumerate(zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist())):
                x = flat[at[k]: at[k + 1]]
                if held and (len(held) == BLOCK or len(held[0][2]) != len(x)):
                    yield out()
                    held = []
                held.append((i, label, x))
        if held:
            yield out()

    return cut(dealt.select("vec_id", "label", "v").mapInArrow(pack, _PACKED), "negatives-blocks")


def _chunked(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Queries as arrays of about ``CHUNK``, one copy for each group of blocks of their length."""
    parts = max(1, -(-queries.count() // CHUNK))
    chunks = (queries.withColumn("dim", F.size("v")).withColumn("part", F.pmod(F.xxhash64("akey"), F.lit(parts)))
              .groupBy("dim", "part").agg(F.collect_list(F.struct("vec_id", "akey", "label", "v", "windows")).alias("queries")))
    return chunks.join(blocks.select("dim", "grp").distinct(), "dim")


class _Chunk:
    """The queries of a chunk in order of their keys, with their windows in order of theirs."""

    def __init__(self, queries: pa.StructArray):
        own, akey, label = (queries.field(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "akey", "label"))
        v = queries.field("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), -1)
        windows, sizes = queries.field("windows").flatten(), pc.list_value_length(queries.field("windows")).to_numpy()
        q, key = np.repeat(akey, sizes), windows.field("key").to_numpy()
        by, order = np.lexsort((key, q)), np.argsort(akey, kind="stable")
        self.own, self.akey, self.label, self.v = own[order], akey[order], label[order], v[order]
        # windows that a query has fewer of than others are empty
        place = (np.arange(len(q)) - np.searchsorted(q[by], q[by]), np.searchsorted(self.akey, q[by]))
        shape = (int(sizes.max(initial=0)), len(own))
        self.key, self.low, self.high = np.zeros(shape, np.int64), np.full(shape, np.inf), np.full(shape, -np.inf)
        for to, c in ((self.key, "key"), (self.low, "low"), (self.high, "high")):
            to[place] = windows.field(c).to_numpy()[by]


def _search(pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """(akey, key, score, vec_id): what every block has for the windows (key, low, high) of the
    queries of the chunks it meets, as far as it can be among the k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: OrderedDict[bytes, CoverTree] = OrderedDict()
        # what a query has found in this task: no row below its worst can be among the k best of all
        carried: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for ids, labels, vs, queries in zip(*[b.column(c) for c in ("ids", "labels", "vectors", "queries")]):
                raw = ids.as_py() + labels.as_py()
                if raw not in trees:
                    i = np.frombuffer(ids.as_py(), np.int64)
                    trees[raw] = CoverTree(i, np.frombuffer(labels.as_py(), np.int64),
                                           np.frombuffer(vs.as_py(), np.float64).reshape(len(i), -1))
                    if len(trees) > TREES:
                        trees.popitem(last=False)
                c = _Chunk(queries.values)
                name = c.akey.tobytes() + c.key.tobytes()
                if name not in carried:
                    if sum(s.size for s, _ in carried.values()) > HELD * k:  # bounds only: without them a block gives more rows than needed
                        carried.clear()
                    carried[name] = np.full((*c.key.shape, k), -np.inf), np.zeros((*c.key.shape, k), np.int64)
                scores, found = carried[name]
                for x in range(0, len(c.own), STRIP):
                    part = slice(x, x + STRIP)
                    some = Queries(trees[raw], c.own[part], c.label[part], c.v[part], same)
                    w, q, score, i = some.best(k, c.low[:, part], c.high[:, part], scores[:, part], found[:, part])
                    if len(w):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c.akey[part][q]), pa.array(c.key[:, part][w, q]), pa.array(score.astype(np.int64)), pa.array(i)],
                            ["akey", "key", "score", "vec_id"])

    return pairs.select("ids", "labels", "vectors", "queries").mapInArrow(run, "akey long, key long, score long, vec_id long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and
    each of its best rows of the same label, the best rows of other labels with a score of
    ``low_percent`` to ``high_percent`` percent of the positive's."""
    rows = cut(usable(vectors, label), "negatives-usable")
    # the ids an answer can name of equal rows: the best few and, where it is one of them, the anchor
    blocks = blocks_of(rows, max(positives, negatives) + 1)
    anchors = rows.where(is_anchor).withColumn("akey", F.xxhash64("vec_id", "label", "v"))
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))

    # the tables are small for the work on them: the number of tasks follows the groups, not the bytes
    tasks = 2 * max(1, blocks.select("dim", "grp").distinct().count())

    def search(queries: DataFrame, k: int, same: bool) -> DataFrame:
        left, right = (df.repartition(tasks, "dim", "grp") for df in (blocks, _chunked(queries, blocks)))
        return _search(left.join(right, ["dim", "grp"]), k, same)

    near = search(anchors.withColumn("windows", any_score), positives, True)
    place = F.row_number().over(Window.partitionBy("akey").orderBy(F.desc("score"), "vec_id"))
    chosen = cut(near.withColumn("at", place).where(F.col("at") <= positives)
                 .select("akey", F.col("at").cast("long").alias("key"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score")), "negatives-positives")
    # scores are whole numbers, so the window's ends are too: low * p <= 100 * s <= high * p
    p = F.col("positive_score")
    window = F.struct("key", F.ceil(p * low_percent / F.lit(100)).cast("double").alias("low"),
                      F.floor(p * high_percent / F.lit(100)).cast("double").alias("high"))
    windows = (chosen.where(p * low_percent <= p * high_percent).groupBy("akey").agg(F.collect_list(window).alias("windows")))
    found = search(cut(anchors.join(windows, "akey"), "negatives-windows"), negatives, False)
    place = F.row_number().over(Window.partitionBy("akey", "key").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("rank", place).where(F.col("rank") <= negatives)
    return (best.join(chosen, ["akey", "key"]).join(anchors.select("akey", F.col("vec_id").alias("anchor_id")), "akey")
            .where((100 * F.col("score") >= low_percent * p) & (100 * F.col("score") <= high_percent * p))
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
