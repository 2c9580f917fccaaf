"""Benchmark decontamination with SimHash windows, in DataFrame functions alone.

1. Words are runs of letters and digits, lower-cased. Windows have the size of an item, in
   words. A window is looked at where it lines up a five-word shingle that it shares with
   an item; a window without any shared shingle has similarity 0 and needs no fingerprint.
2. Each window and each item gets a 64-bit SimHash of its words and word pairs.
3. Multi-index: a fingerprint is cut into ``BLOCKS`` pieces. Two fingerprints within
   ``BLOCKS`` - 1 bits agree in at least one piece, so joining windows and items of one size
   on (piece number, piece) finds every pair within that radius; the distance is then
   checked in full.
4. A leak can lie further apart than the radius, as where a passage is cut off. So every
   window is also paired with the items of its size of which it has a rare shingle: the
   rarest, up to more than 1 - ``SIMILARITY`` of the item's weight. A window without any
   of them cannot reach ``SIMILARITY``, so no pair is lost to the fingerprints.
5. The pairs are verified on the exact shingle sets: the weight of the common shingles over
   the weight of all, a shingle weighing ln(1 + items / items that have it), one that no
   item has like one that a single item has. Pairs of ``SIMILARITY`` or more are leaks.

The shingles of the items are broadcast when there are at most ``BROADCAST_ROWS`` of them
(counted first); beyond that they are joined by a shuffle.

Cases: null and empty texts, and texts of fewer than five words, have no leaks; items of
fewer than five words are not looked for; a document shorter than an item is compared as
a whole; repeated rows leak each; rows without a doc_id are told apart by their texts, and
their leaks have a null doc_id; empty tables give no leaks; extra columns are ignored by
``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, spread, texts

SHINGLE, SIMILARITY, BLOCKS = 5, 0.8, 12
BROADCAST_ROWS = 1_000_000
_BITS = 64


def _doc(doc_id: Column, text: Column) -> Column:
    """The key of a row, never null: its doc_id, or where that is null a hash of its text."""
    return F.struct(F.coalesce(doc_id, F.xxhash64(text)).alias("id"), doc_id.isNull().alias("unnamed"))


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(_doc(F.col("doc_id"), F.col("text")).alias("doc"), "text")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column) -> Column:
    """Hashes of the runs of five words, in order; none for fewer words."""
    at = F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1))
    made = F.transform(at, lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(SHINGLE)]))
    return F.when(F.size(w) >= SHINGLE, made).otherwise(F.array().cast("array<long>"))


def simhash(w: Column) -> Column:
    """64 signs of the sums, bit by bit, over the hashes of words and neighbouring word pairs."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1)))
    features = F.concat(F.transform(w, lambda x: F.xxhash64(x)),
                        F.when(F.size(w) > 1, pairs).otherwise(F.array().cast("array<long>")))
    return F.transform(F.array(features), lambda f: F.aggregate(
        F.sequence(F.lit(0), F.lit(_BITS - 1)), F.lit(0).cast("long"),
        lambda acc, bit: acc.bitwiseOR(F.when(
            F.aggregate(f, F.lit(0), lambda n, h: n + F.getbit(h, bit).cast("int")) * 2 > F.size(f),
            F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))))[0]


def pieces(print_: Column) -> Column:
    """(number, value) of each piece of a fingerprint."""
    edge = [_BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(print_, edge[k]).bitwiseAND(
        F.lit((1 << (edge[k + 1] - edge[k])) - 1)).alias("value")) for k in range(BLOCKS)])


def item_table(benchmark: DataFrame) -> DataFrame:
    """(item_id, size, shingles, weights, print) of the items that can be looked for."""
    w = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.coalesce("text", F.lit(""))).alias("w"))
         .where(F.size("w") >= SHINGLE))
    return w.select("item_id", F.size("w").alias("size"), shingles(F.col("w")).alias("row"), simhash(F.col("w")).alias("print"))


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``leaks`` with the key of the row, ``doc``, for doc_id."""
    items = cut(item_table(benchmark), "items")
    entries = items.select("item_id", "size", F.posexplode("row").alias("at", "h"))
    n_items, n_entries = items.count(), entries.count()
    small = (lambda t: F.broadcast(t)) if n_entries <= BROADCAST_ROWS else (lambda t: t)
    alignments = entries.select("h", "size", "at").distinct()
    # the windows: shared shingles, lined up with the items' sizes
    rows = spread(_keyed(docs)).select("doc", words(F.col("text")).alias("w"))
    hits = (rows.select("doc", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"))).alias("pos", "h"))
            .join(small(alignments), "h"))
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n") - F.col("size")))
    windows = cut(hits.select("doc", start.alias("start"), "size").distinct(), "windows")
    by_doc = windows.groupBy("doc").agg(F.collect_set(F.struct("start", "size")).alias("windows"))
    own = (_keyed(docs).join(by_doc, "doc").select("doc", words(F.col("text")).alias("w"), F.explode("windows").alias("x"))
           .select("doc", F.col("x.start").alias("start"), F.col("x.size").alias("size"),
                   F.slice("w", F.col("x.start") + 1, F.col("x.size")).alias("w")))
    prints = cut(own.select("doc", "start", "size", simhash(F.col("w")).alias("print"),
                            F.array_distinct(shingles(F.col("w"))).alias("row")), "prints")
    # multi-index join, then the distance in full
    left = prints.select("doc", "start", "size", F.col("print").alias("p"), F.explode(pieces(F.col("print"))).alias("x"))
    right = items.select("item_id", "size", F.col("print").alias("q"), F.explode(pieces(F.col("print"))).alias("x"))
    near = (left.join(small(right), ["size", "x"])
            .where(F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) < BLOCKS)
            .select("doc", "start", "size", "item_id"))
    # pairs beyond the radius: windows with one of an item's rarest shingles
    df = entries.select("h", "item_id").distinct().groupBy("h").agg(F.log1p(F.lit(float(n_items)) / F.count("*")).alias("weight"))
    weights = cut(entries.select("item_id", "size", "h").distinct().join(df, "h"), "weights")
    of_item = Window.partitionBy("item_id")
    before = F.sum("weight").over(of_item.orderBy(F.desc("weight"), "h").rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
    rare = (weights.withColumn("before", before).withColumn("all", F.sum("weight").over(of_item))
            .where(F.col("before") <= (1 - SIMILARITY) * F.col("all") + 1e-6).select("item_id", "size", "h"))
    far = prints.select("doc", "start", "size", F.explode("row").alias("h")).join(small(rare), ["size", "h"])
    near = near.union(far.select("doc", "start", "size", "item_id")).distinct()
    # exact weighted similarity
    weighted = weights.groupBy("item_id").agg(F.collect_list(F.struct("h", "weight")).alias("item"))
    pair = near.join(prints.select("doc", "start", "size", "row"), ["doc", "start", "size"]).join(weighted, "item_id")
    item = F.col("item")

    def weight(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["weight"])

    common = weight(F.filter(item, lambda x: F.array_contains("row", x["h"])))
    more = F.size(F.array_except("row", F.transform(item, lambda x: x["h"]))) * F.log1p(F.lit(float(n_items)))
    scored = pair.select("doc", "item_id", "start", "size", (common / (weight(item) + more)).alias("similarity"))
    return (scored.where(F.col("similarity") >= SIMILARITY).groupBy("doc", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "size")).alias("best"))
            .select("doc", "item_id", (-F.col("best.s")).cast("long").alias("start"),
                    F.col("best.size").cast("long").alias("size"), F.round("best.similarity", 9).alias("similarity")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, size, similarity): the best window of each leaked item in each
    document, ``start`` counted in words from 0."""
    return _leaks(docs, benchmark).select(F.when(~F.col("doc.unnamed"), F.col("doc.id")).alias("doc_id"),
                                          "item_id", "start", "size", "similarity")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item leaked."""
    found = cut(_leaks(docs, benchmark).select(F.col("doc").alias("_leaked")).distinct(), "leaked")
    own = _doc(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, own == found["_leaked"], "left_anti")
