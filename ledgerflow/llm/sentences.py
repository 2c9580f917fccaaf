"""Removal of repeated runs of consecutive sentences.

A sentence ends at white space behind ``.``, ``!`` or ``?``, or at a line break. A run has at
least ``RUN`` sentences and ``WORDS`` words, or ``LONG`` words in fewer sentences. The first
occurrence of a run, by doc_id, then place, stays; every sentence covered by a later
occurrence of any run goes.

Two runs a sentence stand for all: the shortest that starts and the shortest that ends at
it. In a repeated run, those that start in it and those that end at its last sentence lie
in it and cover it whole, and they repeat wherever it does. Their case-folded words are hashed
(96 bits) and the runs of all documents joined on the hash.

Counts and the smallest doc_id of a run are combined before the shuffle, and the join back
to the places of a common run is one that Spark splits when skewed. A document's ranges
are bounded by its sentences.

Cases: null and empty texts have no sentences and come back as they are; a repeated doc_id is
one document, its rows keep what each has first; a row without a doc_id has no place in the
order, so that it comes back as it is and its runs do not count for others; an empty table gives no rows; extra
columns are ignored by the query and kept by ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, texts

RUN, WORDS, LONG = 2, 12, 40
_SENTENCE = re.compile(r"[^\S\n]*\n\s*|(?<=[.!?])\s+")


def sentences(t: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, white space between them left out."""
    out, at = [], 0
    for m in _SENTENCE.finditer(t):
        if m.start() > at and t[at:m.start()].strip():
            out.append((at, m.start()))
        at = m.end()
    if t[at:].strip():
        out.append((at, len(t)))
    return out


def bounds(sizes: list[int], run: int, least: int, alone: int) -> list[tuple[int, int]]:
    """First and last sentence of the shortest runs that start, and that end, at each sentence."""
    n = len(sizes)
    out = set()
    last, total = -1, 0  # the run i..last has `total` words
    for i in range(n):
        if last < i:
            last, total = i, sizes[i]
        while (last - i + 1 < run or total < least) and total < alone and last + 1 < n:
            last += 1
            total += sizes[last]
        if not (last - i + 1 >= run and total >= least or total >= alone):
            break  # the rest of the text is too short
        out.add((i, last))
        total -= sizes[i]
    first, total = 0, 0  # the run first..j has `total` words
    for j in range(n):
        total += sizes[j]
        while first < j and (j - first >= run and total - sizes[first] >= least or total - sizes[first] >= alone):
            total -= sizes[first]
            first += 1
        if j - first + 1 >= run and total >= least or total >= alone:
            out.add((first, j))
    return sorted(out)


def runs(t: str, run: int = RUN, least: int = WORDS, alone: int = LONG) -> list[tuple[int, int, int, int, bool]]:
    """(hash, more hash, first sentence, last sentence, seen before in this text) of every run."""
    words = [t[a:b].casefold().split() for a, b in sentences(t)]
    joined = [" ".join(w) for w in words]
    out, seen = [], set()
    for i, last in bounds([len(w) for w in words], run, least, alone):
        h = xxhash.xxh3_128_intdigest("\n".join(joined[i: last + 1]))
        key = (h & (2 ** 64 - 1)) - 2 ** 63, (h >> 64) & 0x7FFFFFFF
        out.append((*key, i, last, key in seen))
        seen.add(key)
    return out


def run_table(docs: DataFrame) -> DataFrame:
    """One row per run of every document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
        for b in batches:
            rows = [(*r, d) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()) for r in runs(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["h", "more", "a", "b", "again", "doc_id"])

    return texts(docs).where("doc_id IS NOT NULL").mapInArrow(
        find, "h long, more int, a int, b int, again boolean, doc_id long")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, ranges): the sentences, by first and last number, of the runs that are not first."""
    table = cut(run_table(docs), "runs")
    # written first: a join straight behind the aggregation could not be split where skewed
    shared = cut(table.groupBy("h", "more").agg(F.count("*").alias("times"), F.min("doc_id").alias("first"))
                 .where("times > 1").select("h", "more", "first"), "shared-runs")
    later = table.join(shared, ["h", "more"]).where("again OR doc_id > first")
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


def without(t: str, ranges: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the sentences in the ranges, how many it had, how many went."""
    places = sentences(t)
    gone = [False] * len(places)
    for a, b in ranges:
        gone[a: b + 1] = [True] * (min(b + 1, len(places)) - a)
    if not any(gone):
        return t, len(places), 0
    out, at = [], 0
    for k, ((a, _), g) in enumerate(zip(places, gone)):
        if g:
            out.append(t[at:a])
            at = places[k + 1][0] if k + 1 < len(places) else len(t)
    out.append(t[at:])
    return "".join(out), len(places), sum(gone)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text) of every document, ``text`` without later occurrences."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [without(t, [(r["a"], r["b"]) for r in ranges or ()]) for t, ranges in
                    zip(b.column("text").to_pylist(), b.column("ranges").to_pylist())]
            kept, n, gone = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_sentences", "n_removed", "text"])

    return (texts(docs).join(repeated_ranges(docs), "doc_id", "left")
            .mapInArrow(drop, "doc_id long, n_sentences long, n_removed long, text string"))
