"""Best-two-fit packing of tokenised documents into sequences of at most ``size`` tokens.

Method: a sequence is opened with the longest piece left and filled greedily with the
longest piece that still fits; then its shortest piece is taken out if two unpacked
pieces fit the widened gap more tightly, the pair with the largest sum being chosen.

How it scales: only lengths matter, and there are at most ``size`` of them. The plan is
made over the histogram of lengths, on the driver, at most ``size`` numbers whatever the
corpus; a filled sequence is laid out as often as its lengths last, so every step uses up
at least one length or its rest. Pieces then take their places by their rank among pieces
of the same length: the rank within a task's share plus the counts of earlier shares. No
step brings the pieces of one length, source or copy group together.

Cases: null text is empty, an empty document is its end id; repeated doc_ids are packed
each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, texts
from ledgerflow.llm.tokens import encoder

PIECES = "share int, length int, local_rank long, doc_id long, piece int, start long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """One row per piece: ids (packed, little-endian, as wide as the vocabulary needs), only
    documents longer than ``size`` cut, and its rank among the task's pieces of that length."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, share = encoder(tokenizer), TaskContext.get().partitionId()
        wide, seen = enc.dtype.itemsize, np.zeros(size + 1, np.int64)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            rows: list[tuple] = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), size * wide)):
                    part = ids[at: at + size * wide]
                    n = len(part) // wide
                    rows.append((share, n, int(seen[n]), doc, k, at // wide, part))
                    seen[n] += 1
            if rows:
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 [x.split()[0] for x in PIECES.split(", ")])

    return texts(docs).mapInArrow(cut_up, PIECES)


def plan_packing(lengths: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: (length, first rank, rows, per sequence, first sequence, first
    offset). A row says: ranks from the first one on, ``per sequence`` at a time, go to
    consecutive sequences, one behind the other from the offset."""
    left = np.zeros(size + 1, np.int64)
    left[lengths] = counts
    given, places, sequence = np.zeros(size + 1, np.int64), [], 0
    have = np.flatnonzero(left)

    def longest(most: int, used: dict[int, int]) -> int:
        k = int(np.searchsorted(have, most, "right")) - 1
        while k >= 0 and left[have[k]] <= used.get(int(have[k]), 0):
            k -= 1
        return int(have[k]) if k >= 0 else 0

    while len(have):
        first = int(have[-1])
        used, gap = {first: 1}, size - first
        while gap and (x := longest(gap, used)):
            n = min(gap // x, int(left[x]) - used.get(x, 0))
            used[x] = used.get(x, 0) + n
            gap -= n * x
        short = min(used)
        if gap and len(used) + used[short] > 2 and (pair := _two_fit(have, left, used, short, gap + short)):
            used[short] -= 1
            for x in pair:
                used[x] = used.get(x, 0) + 1
            used = {x: n for x, n in used.items() if n}
        times = min(int(left[x]) // n for x, n in used.items())
        offset = 0
        for x in sorted(used, reverse=True):
            places.append((x, int(given[x]), times * used[x], used[x], sequence, offset))
            given[x] += times * used[x]
            left[x] -= times * used[x]
            offset += x * used[x]
        sequence += times
        have = have[left[have] > 0]
    return places


def _two_fit(have: np.ndarray, left: np.ndarray, used: dict[int, int], short: int, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum over ``short`` and at most ``room``."""
    free = {x: int(left[x]) - n for x, n in used.items()}
    fit = have[: int(np.searchsorted(have, room - 1, "right"))]
    fit = np.array([x for x in fit.tolist() if free.get(x, 1) > 0], np.int64) if any(n <= 0 for n in free.values()) else fit
    if not len(fit):
        return None
    k = np.searchsorted(fit, room - fit, "right") - 1
    ok = k >= 0
    a, b = fit[ok], fit[k[ok]]
    total = a + b
    for at in np.argsort(-total, kind="stable"):
        x, y = int(a[at]), int(b[at])
        if x + y <= short:
            return None
        if x != y or left[x] - used.get(x, 0) >= 2:
            return x, y
    return None


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, size: int = 4096) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) for every piece; ``ids`` are
    little-endian unsigned 32-bit."""
    pieces = cut(token_pieces(docs, tokenizer, end_id, size), "pieces")
    by_share = pieces.groupBy("share", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_share.select("share", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # at most `size` rows
    counts = by_share.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").toPandas()
    plan = plan_packing(counts["length"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), size)
    place = np.array(sorted(plan), np.int64).reshape(-1, 6)
    key = (place[:, 0] << 45) + place[:, 1]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = encoder(tokenizer).dtype
        for b in batches:
            n = b.column("length").to_numpy().astype(np.int64)
            rank = b.column("local_rank").to_numpy() + b.column("earlier").to_numpy()
            at = np.searchsorted(key, (n << 45) + rank, "right") - 1
            behind, per = rank - place[at, 1], place[at, 3]
            ids = [np.frombuffer(x, wide).astype("<u4").tobytes() for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("piece"), b.column("start"), pa.array(n), pa.array(ids, pa.binary()),
                 pa.array(place[at, 4] + behind // per), pa.array(place[at, 5] + behind % per * n)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    return (pieces.join(offsets, ["share", "length"])
            .mapInArrow(seat, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"))


def packing_digest(docs: DataFrame) -> DataFrame:
    """The packing with a checksum in place of the ids."""
    out = pack(docs)
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
