"""Removal of every byte that lies in a long string occurring more than once.

Exact rule: a byte goes if some ``SPAN``-byte string covers it that also starts at another
place of any document, overlaps and the same document included.

1. Classes. Copies of a text of ``SPAN`` bytes or more go whole; one of them stands for all below.
2. Anchors. Among the ``GRAM``-byte strings inside each ``SPAN``-byte string, the one with the least
   hash is an anchor. Equal strings choose equal anchors, so two occurrences of a string
   share the anchor's hash; anchors whose hash occurs once need no look.
3. Contexts. An occurrence of an anchor brings the text in which its strings can lie:
   ``SPAN`` - ``GRAM`` bytes before it and ``SPAN`` from it on. Equal contexts are counted together before
   any grouping, so copies and shared passages become one row with a count.
4. Enhanced suffix array per anchor: the suffixes that start at the anchor are sorted, their
   common prefix lengths scanned with a stack into the tree of common-prefix intervals.
   Members of an interval of depth r agree on r bytes to the right. If they do not all
   continue alike to the left (left-extension diversity), they are sorted by their left
   sides within the interval, and each gets the longest left part l that it shares with
   another member; l + r >= ``SPAN`` is a maximal repeat around the anchor, and it is noted for
   every member, not just for neighbours in the array.
5. Anchors with more than ``GROUP`` different contexts do not go to one task. Their strings are
   hashed window by window, packed, combined within each pack and counted by hash ranges,
   which finds the same bytes.

Cases: null and empty texts and texts shorter than ``SPAN`` bytes stay whole; a repeated
doc_id is one document per row; equal rows are copies of each other; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, mix64, texts

SPAN, GRAM, GROUP = 400, 100, 4096
#: Contexts hashed together, and hashes counted together.
PACK, BUCKET = 256, 4_000_000

_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(2 * n, np.uint64(base))
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def window_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width``-byte string of ``raw``, by start."""
    n = len(raw)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[:n], out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * down[: n - width + 1])


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours, from running extremes of blocks."""
    pick, fill = (np.minimum, np.uint64(2 ** 64 - 1)) if least else (np.maximum, np.uint64(0))
    blocks = np.full(-(-len(x) // width) * width, fill, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return pick(back[:n], ahead[width - 1: width - 1 + n])


def anchors(raw: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text (ties included)."""
    if len(raw) < span:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    h = window_hashes(raw, gram)
    width = span - gram + 1
    low = np.zeros(len(h) + width - 1, np.uint64)
    low[width - 1: len(h)] = _sliding(h, width, True)
    at = np.flatnonzero(_sliding(low, width, False) == h)
    return at.astype(np.int32), h[at].view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: a text brings many contexts, and its bytes are held twice."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _cls(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - 2 ** 63


def document_anchors(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(doc_id, digest, cls, n_bytes, sha256, places, hashes) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            raws = [t.encode() for t in b.column("text").to_pylist()]
            found = [anchors(np.frombuffer(r, np.uint8), span, gram) for r in raws]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([xxhash.xxh3_128_digest(r) for r in raws], pa.binary()),
                 pa.array([_cls(r) for r in raws], pa.int64()), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([hashlib.sha256(r).hexdigest() for r in raws], pa.string()),
                 pa.array([p for p, _ in found], pa.list_(pa.int32())),
                 pa.array([h for _, h in found], pa.list_(pa.int64()))],
                ["doc_id", "digest", "cls", "n_bytes", "sha256", "places", "hashes"])

    return texts(docs).mapInArrow(run, "doc_id long, digest binary, cls long, n_bytes long, sha256 string, "
                                       "places array<int>, hashes array<long>")


def repeated_anchors(own: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, places, hashes): of one text per class, the anchors whose hash occurs again."""
    first = own.join(classes.select("digest", "rep"), "digest").where("doc_id <=> rep")
    each = (first.groupBy("cls").agg(F.first("places").alias("places"), F.first("hashes").alias("hashes"))
            .select("cls", F.explode(F.arrays_zip("places", "hashes")).alias("x"))
            .select("cls", F.col("x.places").alias("place"), F.col("x.hashes").alias("fp")))
    again = each.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    return each.join(again, "fp").groupBy("cls").agg(F.collect_list(F.struct("place", "fp")).alias("anchors"))


def anchored_texts(docs: DataFrame, classes: DataFrame, places: DataFrame, repeated: bool) -> DataFrame:
    """(cls, raw, anchors): the texts that have anchors to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = [t.encode() for t in b.column("text").to_pylist()]
            # a repeated doc_id can bring other texts along
            keep = pa.array([_cls(r) == c for r, c in zip(raws, b.column("cls").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array(raws, pa.binary()), b.column("anchors")],
                                             ["cls", "raw", "anchors"]).filter(keep)

    wanted = classes.select("cls", "rep").join(places, "cls")
    own = texts(docs)
    out = (own.join(wanted, own["doc_id"].eqNullSafe(wanted["rep"])).select("cls", "text", "anchors")
           .mapInArrow(run, "cls long, raw binary, anchors array<struct<place:int,fp:long>>"))
    return out.dropDuplicates(["cls"]) if repeated else out


def _contexts(b: pa.RecordBatch, span: int, gram: int) -> Iterator[tuple[int, int, int, int, bytes, bytes]]:
    """(cls, place, hash, bytes before the anchor, context, its key) of each anchor."""
    for cls, raw, places in zip(b.column("cls").to_pylist(), b.column("raw").to_pylist(), b.column("anchors").to_pylist()):
        for x in places:
            p, fp = x["place"], x["fp"]
            left = min(p, span - gram)
            ctx = raw[p - left: p + span]
            yield cls, p, fp, left, ctx, xxhash.xxh3_128_digest(ctx + fp.to_bytes(8, "little", signed=True)
                                                                + left.to_bytes(2, "little"))


def occurrences(held: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, cls, place): where each context is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows = [(key, cls, p) for cls, p, _, _, _, key in _contexts(b, span, gram)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int32()))],
                    ["key", "cls", "place"])

    return held.mapInArrow(run, "key binary, cls long, place int")


def contexts(held: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, fp, left_, ctx, n): the different contexts and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows: dict[bytes, list] = {}
            for _, _, fp, left, ctx, key in _contexts(b, span, gram):
                rows.setdefault(key, [key, fp, left, ctx, 0])[4] += 1
            if rows:
                kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows.values()), kinds)],
                                                 ["key", "fp", "left_", "ctx", "n"])

    return (held.mapInArrow(run, "key binary, fp long, left_ int, ctx binary, n long").groupBy("key")
            .agg(F.first("fp").alias("fp"), F.first("left_").alias("left_"), F.first("ctx").alias("ctx"), F.sum("n").alias("n")))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def interval_tree(common: list[int]) -> list[tuple[int, int, int]]:
    """(depth, first, last) of every common-prefix interval of a sorted array, by a stack scan
    over the common prefix lengths of neighbours."""
    out, stack = [], []  # open intervals: (depth, first)
    for k, depth in enumerate([*common, -1]):
        first = k
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            out.append((d, first, k))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def maximal_repeats(group: list[tuple[bytes, int, bytes, int]], span: int) -> dict[bytes, list[tuple[int, int]]]:
    """For contexts (key, bytes before the anchor, text, times) of one anchor, the repeated
    stretches of each, as start and end from the anchor."""
    found: dict[bytes, list[tuple[int, int]]] = {}
    for key, left, ctx, n in group:
        if n > 1 and len(ctx) >= span:
            found[key] = [(-left, len(ctx) - left)]
    group = [g for g in group if g[3] == 1 or len(g[2]) >= span]
    if len(group) < 2 or all(g[0] in found for g in group):
        return found
    right = [ctx[left:] for _, left, ctx, _ in group]
    before = [ctx[:left][::-1] for _, left, ctx, _ in group]
    order = sorted(range(len(group)), key=right.__getitem__)
    lcp = [_common(right[a], right[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(len(group)), key=before.__getitem__)
    rank = np.empty(len(group), np.int64)
    rank[by_left] = np.arange(len(group))
    left_lcp = np.array([_common(before[a], before[b]) for a, b in zip(by_left, by_left[1:])], np.int64)
    most_left = int(left_lcp.max(initial=0))
    whole = np.array([g[0] in found for g in group])
    order_ = np.array(order)
    for depth, first, last in interval_tree(lcp):
        if depth + most_left < span:
            continue
        members = order_[first: last + 1]
        if whole[members].all():
            continue
        members = members[np.argsort(rank[members])]
        # shared left parts of members next to each other in left order
        shared = np.minimum.reduceat(left_lcp, rank[members][:-1]) if len(members) < len(group) else left_lcp
        if len(members) < len(group):
            shared[-1] = left_lcp[rank[members[-2]]: rank[members[-1]]].min()
        if shared.max() + depth < span:
            continue
        if shared.min() == shared.max():  # all continue alike: one repeat for the whole interval
            left = np.full(len(members), shared[0])
        else:
            left = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
        for x, far in zip(members.tolist(), left.tolist()):
            if far + depth >= span and not whole[x]:
                found.setdefault(group[x][0], []).append((-far, depth))
    return found


_RANGES = "key binary, ranges array<struct<a:int,b:int>>"


def _range_batch(found: list[tuple[bytes, list[tuple[int, int]]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in found], pa.binary()),
         pa.array([[{"a": a, "b": b} for a, b in merged(r)] for _, r in found],
                  pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["key", "ranges"])


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges, as disjoint ones that do not touch."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def group_ranges(rows: DataFrame, span: int) -> DataFrame:
    """(key, ranges) by suffix arrays, all contexts of an anchor in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, group = None, []
        for b in batches:
            found: list = []
            for row in zip(*[b.column(c).to_pylist() for c in ("fp", "key", "left_", "ctx", "n")]):
                if row[0] != fp:
                    found += maximal_repeats(group, span).items()
                    fp, group = row[0], []
                group.append(row[1:])
            if found:
                yield _range_batch(found)
        if found := list(maximal_repeats(group, span).items()):
            yield _range_batch(found)

    return rows.repartition("fp").sortWithinPartitions("fp", "key").mapInArrow(run, _RANGES)


def window_ranges(rows: DataFrame, span: int, gram: int, n: int) -> DataFrame:
    """(key, ranges) by counting hashes of whole strings, for anchors with very many contexts;
    ``n`` is the number of rows."""
    # a bucket of hashes is counted in one go: their number follows the data, not the cluster
    buckets = 1 + n * (span - gram + 1) // BUCKET

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, part = 0, TaskContext.get().partitionId()
        for b in batches:
            for at in range(0, b.num_rows, PACK):
                p = b.slice(at, PACK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + k]), *[pa.array([p.column(c).to_pylist()], pa.list_(p.column(c).type))
                                                     for c in ("fp", "key", "left_", "ctx", "n")]],
                    ["uid", "fp", "key", "left_", "ctx", "n"])
                k += 1

    packs = cut(rows.mapInArrow(pack, "uid long, fp array<long>, key array<binary>, left_ array<int>, "
                                      "ctx array<binary>, n array<long>").repartition("uid"), "packs")

    def hashed(fps: list[int], lefts: list[int], ctxs: list[bytes]) -> list[np.ndarray]:
        # by anchor and distance to it: a string of one text lies in the contexts of several
        # anchors, but in one at a given distance
        own = mix64(np.array(fps, np.int64).view(np.uint64))
        return [mix64(window_hashes(np.frombuffer(c, np.uint8), span) ^ o) + np.arange(k, k - max(0, len(c) - span + 1), -1).view(np.uint64)
                for c, k, o in zip(ctxs, lefts, own)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, fps, lefts, ctxs, n in zip(*[b.column(c).to_pylist() for c in ("uid", "fp", "left_", "ctx", "n")]):
                hs = hashed(fps, lefts, ctxs)
                h, at = np.unique(np.concatenate(hs), return_inverse=True)
                times = np.bincount(at, np.repeat(n, [len(x) for x in hs]), len(h)).clip(max=2).astype(np.uint8)
                bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[by], np.arange(buckets + 1))
                rows_ = [(k, uid, h[by[a:z]].tobytes(), times[by[a:z]].tobytes())
                         for k, (a, z) in enumerate(zip(edge, edge[1:])) if z > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows_), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["bucket", "uid", "hashes", "times"])

    def again(rows_: pd.DataFrame) -> pd.DataFrame:
        hs = [np.frombuffer(x, np.uint64) for x in rows_["hashes"]]
        times = np.concatenate([np.frombuffer(x, np.uint8) for x in rows_["times"]])
        h, at = np.unique(np.concatenate(hs), return_inverse=True)
        often = (np.bincount(at, times, len(h)) > 1)[at]
        parts = np.split(often, np.cumsum([len(x) for x in hs])[:-1])
        return pd.DataFrame({"uid": rows_["uid"], "hashes": [x[o].tobytes() for x, o in zip(hs, parts)]})

    told = (packs.mapInArrow(count, "bucket int, uid long, hashes binary, times binary").groupBy("bucket")
            .applyInPandas(again, "uid long, hashes binary").where(F.length("hashes") > 0)
            .groupBy("uid").agg(F.collect_list("hashes").alias("again")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fps, keys, lefts, ctxs, told_ in zip(*[b.column(c).to_pylist() for c in ("fp", "key", "left_", "ctx", "again")]):
                known = np.unique(np.frombuffer(b"".join(told_), np.uint64))
                hs = hashed(fps, lefts, ctxs)
                h = np.concatenate(hs)
                hit = known[np.searchsorted(known, h).clip(max=len(known) - 1)] == h
                found = []
                for key, left, again_ in zip(keys, lefts, np.split(hit, np.cumsum([len(x) for x in hs])[:-1])):
                    at = np.flatnonzero(again_) - left
                    if len(at):
                        stop = np.flatnonzero(np.diff(at) > 1)
                        found.append((key, list(zip(at[np.append(0, stop + 1)].tolist(),
                                                    (at[np.append(stop, len(at) - 1)] + span).tolist()))))
                if found:
                    yield _range_batch(found)

    return packs.join(told, "uid").mapInArrow(place, _RANGES)


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) of every document; ``spans`` are the maximal
    removed runs as (a, b), b exclusive."""
    own = cut(document_anchors(docs, span, gram), "anchors")
    repeated = bool(own.groupBy("doc_id").count().where("count > 1").limit(1).count())
    classes = own.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("cls").alias("cls"),
                                        F.count("*").alias("copies"), F.min("n_bytes").alias("size"))
    held = cut(anchored_texts(docs, classes, repeated_anchors(own, classes), repeated), "anchored")
    ctx = cut(contexts(held, span, gram), "contexts")
    big = ctx.groupBy("fp").count().where(F.col("count") > group)
    ranges = group_ranges(ctx.join(big.select("fp"), "fp", "left_anti"), span)
    if many := big.agg(F.sum("count")).first()[0]:
        ranges = ranges.union(window_ranges(ctx.join(big.select("fp"), "fp", "left_semi"), span, gram, many))
    of_text = (occurrences(held, span, gram).join(cut(ranges, "ranges"), "key")
               .select("cls", F.transform("ranges", lambda r: F.struct(
                   (r["a"] + F.col("place")).alias("a"), (r["b"] + F.col("place")).alias("b"))).alias("ranges"))
               .groupBy("cls").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for raw, ranges_ in zip(b.column("raw").to_pylist(), b.column("ranges").to_pylist()):
                spans = merged([(r["a"], r["b"]) for r in ranges_])
                kept, at = hashlib.sha256(), 0
                for a, z in spans:
                    kept.update(raw[at:a])
                    at = z
                kept.update(raw[at:])
                done.append(([{"a": a, "b": z} for a, z in spans], kept.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), pa.array([s for s, _ in done], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                 pa.array([k for _, k in done], pa.string())], ["cls", "spans", "kept"])

    changed = held.select("cls", "raw").join(of_text, "cls").mapInArrow(
        drop, "cls long, spans array<struct<a:int,b:int>>, kept string")
    state = classes.select("digest", "cls", "copies").join(changed, "cls", "left").drop("cls")
    rows = own.select("doc_id", "digest", "n_bytes", "sha256").join(state, "digest")
    copy = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n_bytes").cast("int").alias("b")))
    none = F.array().cast("array<struct<a:int,b:int>>")
    spans = F.when(copy, whole).otherwise(F.coalesce("spans", none))
    return rows.select("doc_id", "n_bytes", F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_removed"),
                       spans.alias("spans"), F.when(copy, F.sha2(F.lit(""), 256)).otherwise(
                           F.coalesce("kept", "sha256")).alias("kept_sha256"))


def suffix_digest(docs: DataFrame) -> DataFrame:
    """The removal with the number of runs in place of the runs."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
