"""Token store and packing against the tokenizers library's own encoding."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerflow.llm import packing, token_store
from ledgerflow.llm.common import scratch
from ledgerflow.llm.tokens import Encoder, encoder
from tests.llm.helpers import docs_of, empty_docs, odd_docs, pandas_docs, small

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def whole(tok, texts):
    return [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n.,'sIÉß<|>")),
                        max_size=40), max_size=4))
def test_encoder_equals_library(texts):
    assert encoder(NAME).encode(texts) == whole(encoder(NAME).tok, texts)


def test_full_caches_change_nothing(tok, monkeypatch):
    monkeypatch.setattr("ledgerflow.llm.tokens.CACHE", 3)
    e, texts = Encoder(NAME), ["Some words, more words.", "other words; and MORE", "some words"] * 2
    assert e.encode(texts) == whole(tok, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=60))
def test_codes_round_trip(values):
    control, data = token_store.encode_values(np.array(values, "<u4"))
    assert len(control) == -(-len(values) // 4)
    assert token_store.decode_values(control, data, len(values)).tolist() == values


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=9), max_size=9))
def test_rows_are_coded_together_as_one_by_one(rows):
    n = np.array([len(r) for r in rows], np.int64)
    values = np.array([x for r in rows for x in r], "<u4")
    control, data, groups, size = token_store.encode_rows(values, n)
    alone = [token_store.encode_values(np.array(r, "<u4")) for r in rows]
    assert (control.tobytes(), data.tobytes()) == (b"".join(c for c, _ in alone), b"".join(d for _, d in alone))
    assert (groups.tolist(), size.tolist()) == ([len(c) for c, _ in alone], [len(d) for _, d in alone])
    assert token_store.decode_rows(control, data, n).tolist() == values.tolist()


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_steps_lose_no_row(monkeypatch, step):
    monkeypatch.setattr(token_store, "STEP", step)
    held = pa.array([b"", b"ab", b"abcdef", b"", b"cd", b"efgh", b""], pa.binary())
    b = pa.RecordBatch.from_arrays([held], ["ids"]).slice(1)
    got = [x for c, n in token_store._steps(b, token_store._bytes_of(b.column("ids"))[1] // 2)
           for x in token_store._binary(token_store._bytes_of(c.column("ids"))[0], 2 * n).to_pylist()]
    assert got == held.to_pylist()[1:]
    assert list(token_store._steps(b.slice(0, 0), np.zeros(0, np.int64))) == []


def expected(tok, docs):
    rows = pandas_docs(docs).sort_values("doc_id", kind="stable", na_position="first")
    ids = [np.append(np.frombuffer(x, "<u2").astype("<u4"), np.uint32(1)) for x in whole(tok, rows.text.tolist())]
    return rows.doc_id.tolist(), ids


def test_store_of_small_table(spark, tok):
    order, ids = expected(tok, small(spark))
    want, at = {}, 0
    for d, x in zip(order, ids):
        want[d] = (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.token_store_digest(small(spark)).collect()}
    assert got == want


def test_store_files_are_in_order_and_ranked_by_frequency(spark, tok):
    path = token_store.write_token_store(small(spark), scratch(spark, "order"))
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)
    _, ids = expected(tok, small(spark))
    assert {r.id: r.n for r in ranks} == dict(zip(*[x.tolist() for x in np.unique(np.concatenate(ids), return_counts=True)]))
    shards = spark.read.parquet(f"{path}/shards").select("shard", "local_start", "doc_id").collect()
    assert [r.doc_id for r in sorted(shards, key=lambda r: (r.shard, r.local_start))] == sorted(r.doc_id for r in shards)


def test_store_odd_and_empty(spark, tok):
    got = token_store.token_store_digest(odd_docs(spark)).collect()
    _, ids = expected(tok, odd_docs(spark))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((len(x), zlib.crc32(x.tobytes())) for x in ids)
    assert sorted(r.start for r in got) == sorted(np.cumsum([0, *[r.n_tokens for r in sorted(got, key=lambda r: r.start)]])[:-1])
    assert token_store.token_store_digest(empty_docs(spark)).collect() == []


def check_packing(rows, total, size):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert not at or max(at.values()) <= size
    assert sum(at.values()) == total
    return len(at)


def test_packing_of_small_table(spark, tok):
    order, ids = expected(tok, small(spark))
    rows = packing.packing_digest(small(spark)).collect()
    total = sum(map(len, ids))
    used = check_packing(rows, total, 4096)
    assert used <= -(-total // 4096) + 1
    want = {(d, k // 4096): (k, len(x[k: k + 4096]), zlib.crc32(x[k: k + 4096].tobytes()))
            for d, x in zip(order, ids) for k in range(0, len(x), 4096)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want


def test_packing_odd_and_empty(spark, tok):
    _, ids = expected(tok, odd_docs(spark))
    check_packing(packing.packing_digest(odd_docs(spark)).collect(), sum(map(len, ids)), 4096)
    assert packing.packing_digest(empty_docs(spark)).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=120))
def test_plan_places_every_piece_once(lengths):
    size = 50
    values, counts = np.unique(lengths, return_counts=True)
    bins, ranks = {}, {int(v): [] for v in values}
    for length, first, rows, per, sequence, offset in packing.plan_packing(values, counts, size):
        for k in range(rows):
            ranks[length].append(first + k)
            bins.setdefault(sequence + k // per, []).append((offset + k % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {int(v): list(range(c)) for v, c in zip(values, counts)}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(bins) <= 1.23 * (-(-sum(lengths) // size)) + 2


def test_two_pieces_replace_one():
    # greedy alone leaves 6 + 3 in ten places; 2 + 2 in place of 3 fill it
    plan = packing.plan_packing(np.array([2, 3, 6]), np.array([2, 1, 1]), 10)
    first = sorted(p[0] for p in plan if p[4] == 0 for _ in range(p[3]))
    assert sum(first) == 10


def test_hot_length_is_spread(spark):
    rows = packing.packing_digest(docs_of(spark, ["the same text"] * 500 + ["another one here"] * 50)).collect()
    assert check_packing(rows, sum(r.length for r in rows), 4096) == 1
