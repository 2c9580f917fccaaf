"""Runs of periodic words found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and length at least
``MIN_WORDS`` and ``TIMES`` * q that no neighbouring word extends; words are
``[^\\x20\\x09-\\x0D]+``. A document's words become whole numbers, equal ones where the words
are equal, and many documents are worked on as one array in which no number occurs in
two of them.

1. Names. Strings of 1, 2, 4, ... words get equal names exactly where they are equal, each
   from the two halves; the string of K words from two that overlap. Nothing rests on
   the chance of a hash.
2. Scales. Periods above ``SHORT`` are taken in ranges (lo, K] with K = 1.25 * lo. Of every window of
   2 * (lo + 1) - K + 1 neighbouring strings of K words the one with the least scrambled name is a
   minimizer (ties included). In a run of period q of the range, the window at its start
   and the one q words on both lie inside, hold the same strings and so have minimizers
   q apart; as K >= q, the string occurs nowhere between. So every run has two equal
   minimizers, neighbours among the equal ones of the scale, at its period's distance.
3. Extension. Such a pair is extended both ways while words that distance apart agree; a pair
   in a stretch already found is passed over. A stretch whose words also agree at a
   divisor of the distance has a smaller period, and is left to it. A pair is a
   repetition of exponent two at least, so the stretches of a scale cover a word a bounded
   number of times, and the work is n log n whatever the text.
4. Periods up to ``SHORT``, too short for windows, come from a direct scan of each lag.

Documents in which no string of ``SHORT`` words repeats have no run and are not looked at further,
and scales end when no string of their length repeats.

Cases: null and empty texts have no words and no runs; a text of any length is taken
whole; repeated rows and repeated doc_ids are documents each for itself; a row without a
doc_id is handled like any other; nested and overlapping runs are all reported, by start, then
period; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import mix64, texts

MIN_WORDS, TIMES, SHORT = 24, 3, 8
#: Words worked on as one array; a longer text is an array of its own.
CHUNK = 200_000

Run = tuple[int, int, int]
RUNS = "array<struct<start:long,length:long,period:long>>"


class Names:
    """Names of the strings of K neighbours of an array, equal where the strings are equal."""

    def __init__(self, x: np.ndarray):
        self.ranks = [x]

    def _rank(self, j: int) -> np.ndarray:
        while len(self.ranks) <= j:
            half, size = self.ranks[-1], 1 << (len(self.ranks) - 1)
            pair = half[:-size] * np.int64(len(self.ranks[0]) + 1) + half[size:]
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        return self.ranks[j]

    def of(self, k: int) -> np.ndarray:
        j = k.bit_length() - 1
        r, more = self._rank(j), k - (1 << j)
        return r if not more else r[:-more] * np.int64(len(self.ranks[0]) + 1) + r[more:]

    def repeat(self, k: int) -> bool:
        """Whether a string as long as the largest power of two up to ``k`` occurs twice."""
        r = self._rank(k.bit_length() - 1)
        return len(r) > 0 and int(r.max()) + 1 < len(r)


def _least(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or what ``pick`` takes) of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x, size = pick(x[:-size], x[size:]), 2 * size
    return pick(x[: len(x) - (width - size)], x[width - size:]) if size < width else x


def minimizers(order: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the least of some window of ``width``."""
    if len(order) < width:
        return np.zeros(0, np.int64)
    low = _least(order, width)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_least(np.concatenate([edge, low, edge]), width, np.maximum) == order)


def _ahead(x: np.ndarray, i: int, lag: int) -> int:
    """The first place from ``i`` on whose value differs from the one ``lag`` further."""
    size = 64
    while i + lag < len(x):
        other = x[i + lag: i + lag + size]
        differ = x[i: i + len(other)] != other
        if differ.any():
            return i + int(differ.argmax())
        i, size = i + len(other), 2 * size
    return i


def _behind(x: np.ndarray, i: int, lag: int) -> int:
    """The first place of the stretch around ``i`` of values that equal the ones ``lag`` further."""
    size = 64
    while i > 0:
        a = max(0, i - size)
        differ = x[a:i] != x[a + lag: i + lag]
        if differ.any():
            return i - int(differ[::-1].argmax())
        i, size = a, 2 * size
    return i


def _prime_divisors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def _smallest(x: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of period ``q``, two periods or longer, has no smaller one."""
    two = x[start: start + 2 * q]
    return not any((two[: -(q // p)] == two[q // p:]).all() for p in _prime_divisors(q))


def _long_enough(length: int, q: int) -> bool:
    return length >= max(MIN_WORDS, TIMES * q)


def array_runs(x: np.ndarray, longest: int) -> list[Run]:
    """All runs (start, length, period) of an array of whole numbers below its size whose parts,
    the documents, are ``longest`` at most and have no number in common."""
    out: list[Run] = []
    for q in range(1, SHORT + 1):  # direct lag scans
        if len(x) <= q:
            break
        same = np.zeros(len(x) - q + 2, np.int8)
        same[1:-1] = x[:-q] == x[q:]
        turn = np.diff(same)
        first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        for a, b in zip(first[last - first + q >= MIN_WORDS].tolist(), last[last - first + q >= MIN_WORDS].tolist()):
            if _long_enough(b - a + q, q) and _smallest(x, a, q):
                out.append((a, b - a + q, q))
    names, lo = Names(x), SHORT
    while TIMES * (lo + 1) <= longest:
        k = lo * 5 // 4
        if not names.repeat(k):
            break
        name = names.of(k)
        at = minimizers(mix64(name.view(np.uint64)), 2 * (lo + 1) - k + 1)
        at = at[np.argsort(name[at], kind="stable")]
        gap = np.diff(at)
        seed = (np.diff(name[at]) == 0) & (gap > lo) & (gap <= k)
        place, gap = at[:-1][seed], gap[seed]
        by = np.lexsort((place, gap))
        lag, end = 0, 0
        for m, d in zip(place[by].tolist(), gap[by].tolist()):
            if d == lag and m < end:
                continue
            a, lag, end = _behind(x, m, d), d, _ahead(x, m, d)
            if _long_enough(end - a + d, d) and _smallest(x, a, d):
                out.append((a, end - a + d, d))
        lo = k
    return out


def _with_repeats(arrays: list[np.ndarray]) -> list[int]:
    """Which arrays hold some string of ``SHORT`` numbers twice (by hash; too many do no harm)."""
    at = np.cumsum([0, *map(len, arrays)])
    x = np.concatenate(arrays) + np.repeat(at[:-1], np.diff(at))
    if len(x) < SHORT:
        return []
    h = mix64(x.astype(np.uint64))
    s = np.zeros(len(x) - SHORT + 1, np.uint64)
    for k in range(SHORT):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[k: len(s) + k]
    by = np.argsort(s)
    again = by[1:][s[by[1:]] == s[by[:-1]]]
    return np.unique(np.searchsorted(at, again, "right") - 1).tolist()


def find_runs(arrays: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each of many arrays of numbers, each below the array's size."""
    out: list[list[Run]] = [[] for _ in arrays]
    if not arrays:
        return out
    # arrays of like length together, so that the short ones do not go through the scales of the long
    chosen = sorted(_with_repeats(arrays), key=lambda k: len(arrays[k]))
    a = 0
    while a < len(chosen):
        z, size = a, 0
        while z < len(chosen) and (z == a or size + len(arrays[chosen[z]]) <= CHUNK):
            size += len(arrays[chosen[z]])
            z += 1
        part = [arrays[k] for k in chosen[a:z]]
        at = np.cumsum([0, *map(len, part)])
        x = np.concatenate(part).astype(np.int64) + np.repeat(at[:-1], np.diff(at))
        for start, length, q in array_runs(x, len(part[-1])):
            k = int(np.searchsorted(at, start, "right")) - 1
            out[chosen[a + k]].append((start - int(at[k]), length, q))
        a = z
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers in order of first occurrence."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside runs and of each run's first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every document: its runs by start, then period, and its text
    without the words that repeat a run's first period. ``rewrite`` may change the words of
    a document first."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def slices(b: pa.RecordBatch) -> Iterator[tuple[list, list[list[bytes]]]]:
        ids, held, size = [], [], 0
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
            words = t.as_py().encode().split()  # bytes split at exactly the six separators
            ids.append(i)
            held.append(rewrite(i, words) if rewrite else words)
            size += len(words)
            if size >= CHUNK:
                yield ids, held
                ids, held, size = [], [], 0
        if ids:
            yield ids, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, held in slices(b):
                found = find_runs([numbered(w) for w in held])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], kind),
                     pa.array([collapsed(w, r).decode() for w, r in zip(held, found)], pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return texts(docs).mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: in one of ten documents, by crc32 of the id, the words from some
    place on repeat with a period."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_digest(docs: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent and checksums of every document."""
    found = periodic_runs(docs, repeated_tail)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # exponents compared in whole numbers; runs come by start, then period, and the first of equals stays
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda m, r: F.when(
        r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    text = F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                        F.when(F.size("runs") > 0, best).alias("best"), F.sha2(text, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                       F.col("best.period").alias("period"),
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
