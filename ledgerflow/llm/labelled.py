"""The bounded sample of labelled documents on which both classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, y) of at most ``sample`` labelled documents that are not held out, the
    first by a hash of doc_id. A doc_id with differing labels takes the larger one.

    The sample is the only bound in the classifiers: it limits what is learnt from, not
    what is scored.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .where(~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # at most `sample` rows of two numbers
    return own.join(F.broadcast(chosen), "doc_id")
