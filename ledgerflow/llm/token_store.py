"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Every id is replaced by its rank in the corpus (0 the most frequent, ties by id), so that
frequent tokens take one byte. Ranks are stored as in byte-aligned integer codes with
separate control bytes: two bits of a control byte give the length (1 to 4 bytes) of each
of four values, the values' little-endian bytes follow in a stream of their own, and
numpy decodes four values per control byte by table lookup, without a loop over values or
documents.

A store is a folder with two Parquet tables: ``ranks`` (rank, id, n) and ``shards``, one
row per document in ascending doc_id order (shard, local_start, doc_id, n_tokens, control,
data). Shards are range partitions, written by Spark's committer, so a lost executor's
shard is written again whole. A document's global start is its shard's offset, a running
sum with one row per shard, plus ``local_start``.

Cases: null text is empty; an empty text has only the end id; repeated doc_ids stay, in
order of their ids; null doc_id sorts first; an empty table gives an empty store; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, discard, scratch, texts
from ledgerflow.llm.tokens import encoder

_CODES = (np.arange(256)[:, None] >> (2 * np.arange(4))) & 3
#: Data bytes behind each control byte, and which of the 16 bytes of its four values they are.
DATA_LENGTH = (_CODES + 1).sum(axis=1)
STORED = (np.arange(4) <= _CODES[:, :, None]).reshape(256, 16)
#: Values coded or decoded at once: many documents, so that numpy is called once for all of them.
STEP = 1 << 16


def _places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes of rows of ``n`` values, and each value's place among the filled-up groups."""
    groups = -(-n // 4)
    return groups, np.arange(n.sum()) + np.repeat(4 * (np.cumsum(groups) - groups) - (np.cumsum(n) - n), n)


def encode_rows(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit values, ``n`` of them a row, the last group of a row filled
    up with zeros; then the control bytes and the data bytes of each row."""
    groups, place = _places(n)
    v = np.zeros(4 * int(groups.sum()), "<u4")
    v[place] = values
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    data = v.view(np.uint8)[STORED[control].reshape(-1)]
    upto = np.append(0, np.cumsum(DATA_LENGTH[control]))
    return control, data, groups, np.diff(upto[np.append(0, np.cumsum(groups))])


def decode_rows(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The values of ``encode_rows``, all rows in one array."""
    v = np.zeros(16 * len(control), np.uint8)
    v[STORED[control].reshape(-1)] = data
    return v.view("<u4")[_places(n)[1]]


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of one row of values."""
    control, data, _, _ = encode_rows(values, np.array([len(values)]))
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``encode_values``."""
    return decode_rows(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([n]))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the length of each value."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0]: at[-1]], np.diff(at)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column of values that stand in ``data`` one behind the other."""
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _steps(b: pa.RecordBatch, n: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with about ``STEP`` values each, at least one row, and the values of their rows."""
    step = (np.cumsum(n) - n) // STEP
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(n)]
    for i, j in zip(cuts, cuts[1:]):
        if i < j:
            yield b.slice(i, j - i), n[i:j]


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids): each document's ids with the end id, packed as wide as the vocabulary needs."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            ids = [x + end for x in enc.encode(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return texts(docs).mapInArrow(encode, "doc_id long, ids binary")


def token_counts(table: DataFrame, tokenizer: str) -> DataFrame:
    """(id, n) over all documents, each task adding up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = encoder(tokenizer).dtype, np.zeros(0, np.int64)
        for b in batches:
            got = np.bincount(_bytes_of(b.column("ids"))[0].view(kind))
            if len(got) < len(total):
                got, total = total, got
            total = got + np.pad(total, (0, len(got) - len(total)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return table.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_store(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1) -> str:
    """Write the token ids of all documents, ``end_id`` behind each, and return ``path``."""
    spark = docs.sparkSession
    table = cut(token_table(docs, tokenizer, end_id), "token-ids")
    # one row per id in use: bounded by the tokenizer's vocabulary, whatever the corpus
    found = token_counts(table, tokenizer).toPandas().sort_values(["n", "id"], ascending=[False, True])
    by_rank = found["id"].to_numpy(np.int64)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame([(k, int(i), int(n)) for k, (i, n) in enumerate(zip(by_rank, found["n"]))],
                          "rank int, id int, n long").coalesce(1).write.parquet(f"{path}/ranks")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, start, part = encoder(tokenizer).dtype, 0, TaskContext.get().partitionId()
        for b in batches:
            for c, n in _steps(b, _bytes_of(b.column("ids"))[1] // kind.itemsize):
                values = rank[_bytes_of(c.column("ids"))[0].view(kind)]
                control, data, groups, size = encode_rows(values, n)
                begin = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(begin, pa.int64()), c.column("doc_id"),
                     pa.array(n, pa.int64()), _binary(control, groups), _binary(data, size)],
                    ["shard", "local_start", "doc_id", "n_tokens", "control", "data"])

    (table.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(shard, "shard int, local_start long, doc_id long, n_tokens long, control binary, data binary")
     .write.option("compression", "uncompressed").parquet(f"{path}/shards"))
    discard(spark, table)
    return path


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``ids`` packed little-endian unsigned 32-bit."""
    rows = spark.read.parquet(f"{path}/ranks").select("rank", "id").toPandas()  # bounded by the vocabulary
    by_rank = np.zeros(len(rows), "<u4")
    by_rank[rows["rank"].to_numpy()] = rows["id"].to_numpy()
    shards = spark.read.parquet(f"{path}/shards")
    total = shards.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # one row per shard
    before = total.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, n in _steps(b, b.column("n_tokens").to_numpy()):
                ids = by_rank[decode_rows(_bytes_of(c.column("control"))[0], _bytes_of(c.column("data"))[0], n)]
                yield pa.RecordBatch.from_arrays(
                    [c.column(x) for x in ("shard", "local_start", "doc_id", "n_tokens")] + [_binary(ids.view(np.uint8), 4 * n)],
                    ["shard", "local_start", "doc_id", "n_tokens", "ids"])

    out = shards.mapInArrow(decode, "shard int, local_start long, doc_id long, n_tokens long, ids binary")
    return (out.join(F.broadcast(before), "shard")  # one row per shard
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids"))


def token_store_digest(docs: DataFrame) -> DataFrame:
    """Write the store, read it back, and report each document's place and checksum."""
    spark = docs.sparkSession
    path = write_token_store(docs, scratch(spark, "tokens"))
    return read_token_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
