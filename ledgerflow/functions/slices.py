"""Work on rows that meet by a key, done slice by slice of a hash of the key.

A shuffle holds rows that Parquet packs several times smaller, and holds all of them at once. Where
stored tables meet, their rows are first dealt into folders by a hash of the key, as Parquet and
without a shuffle; then one slice after the other is joined, and its shuffle files and folders go
before the next. Rows of a key are all in one slice, so the slices' results together are the whole's.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import path_exists, remove_path, store

# Slices follow the bytes of the tables up to MOST_SLICES, as a task that deals rows opens a file for each.
SLICE_BYTES, MOST_SLICES = 64 * 1024 * 1024, 16


def stored_bytes(df: DataFrame) -> int:
    """Size of a stored table by its files, all partitions counted."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def slice_count(size: int) -> int:
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def in_slices(sides: list[DataFrame], key: str, scratch: str, size: int | None = None,
              dealt: Callable[[], None] | None = None) -> Iterator[list[DataFrame]]:
    """The stored tables ``sides`` slice by slice: of each the rows of the same values of ``key``. A slice
    is to be worked off before the next one is asked for, as its rows are removed then; they lie
    below ``scratch``. ``size``: the bytes of the files read, where they are not whole tables. ``dealt``
    is called when the rows are copied and ``sides`` read no more. Small tables are one slice and not
    copied."""
    n = slice_count(sum(stored_bytes(df) for df in sides) if size is None else size)
    if n == 1:
        yield sides
        return
    spark, root = sides[0].sparkSession, os.path.join(scratch, f"slices-{uuid.uuid4().hex}")
    paths = [os.path.join(root, str(i)) for i in range(len(sides))]
    try:
        for df, path in zip(sides, paths, strict=True):
            store(df.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), path, partition_by=("_slice",))
        if dealt:
            dealt()
        for k in range(n):
            folders = [os.path.join(path, f"_slice={k}") for path in paths]
            there = [path_exists(spark, f) for f in folders]
            if any(there):
                yield [spark.read.schema(df.schema).parquet(f) if e else df.limit(0)
                       for df, f, e in zip(sides, folders, there, strict=True)]
            for f in folders:
                remove_path(spark, f)
    finally:
        remove_path(spark, root)
