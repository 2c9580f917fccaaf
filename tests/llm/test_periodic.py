"""Periodic runs against a direct scan of every lag."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerflow.llm import periodic
from tests.llm.helpers import ODD, docs_of, empty_docs, odd_docs, small


def every_lag(x):
    """All runs by definition: each lag, each stretch, each smaller period tried."""
    out, n = [], len(x)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q) and not any(
                    all(x[k] == x[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    """The contract's row, straight from its wording."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = every_lag(w)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in dropped)))


def made(rnd):
    """Words with runs of many shapes: nested, touching, cut off, of few or many different words."""
    k, x = rnd.choice([1, 2, 3, 5, 50]), []
    while len(x) < rnd.randrange(1, 500):
        u = [rnd.randrange(k) for _ in range(rnd.randrange(1, 60))]
        x += (u * rnd.randrange(1, 9))[: rnd.randrange(1, 300)]
        if rnd.random() < 0.3 and len(x) > 6:
            x += x[-rnd.randrange(1, len(x)):] * rnd.randrange(1, 4)
    return x[:800]


def test_every_run_is_found():
    rnd, total = random.Random(7), 0
    for _ in range(40):
        arrays = [made(rnd) for _ in range(rnd.randrange(1, 6))]
        got = periodic.find_runs([periodic.numbered([str(v).encode() for v in x]) for x in arrays])
        for x, g in zip(arrays, got):
            want = every_lag(x)
            total += len(want)
            assert g == want
    assert total > 200


@pytest.mark.parametrize("q", [1, 7, 8, 9, 10, 11, 12, 13, 15, 16, 18, 19, 22, 23, 40, 333])
def test_shortest_runs_at_the_rims_of_scales(q):
    unit = [f"u{k}".encode() for k in range(q)]
    length = max(24, 3 * q)
    words = [b"x", b"y"] + (unit * 30)[:length] + [b"z"]
    assert periodic.find_runs([periodic.numbered(words)]) == [[(2, length, q)]]
    assert periodic.find_runs([periodic.numbered(words[:1 + length] + [b"z"])]) == [[]]


def test_large_regular_texts_take_little_time():
    for x in ([0, 1] * 150_000, list(range(30_000)) * 5, [bin(k).count("1") % 2 for k in range(1 << 17)]):
        runs = periodic.find_runs([np.array(x, np.int64)])[0]
        assert len(runs) <= 1


def test_digest_matches_definition(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(f"w{v}" for v in made(rnd))) for k in range(80)]
    rows += [(80 + k, " \t".join(f"w{v}\n" for v in made(rnd))) for k in range(20)]
    got = {r[0]: tuple(r) for r in periodic.periodic_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == expected(i, t)
    assert sum(r[1] for r in got.values()) > 50


def test_small_table_matches_definition(spark):
    docs = small(spark)
    got = {r[0]: tuple(r) for r in periodic.periodic_digest(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    assert [got[i] for i, t in rows if len(t or "") < 20_000] == [expected(i, t) for i, t in rows if len(t or "") < 20_000]
    assert any(r[1] for r in got.values())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = sorted((tuple(r) for r in periodic.periodic_digest(docs).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in ODD), key=str)
    assert periodic.periodic_digest(empty_docs(spark)).count() == 0


def test_operator_gives_text_and_runs(spark):
    text = "intro " + "a b c " * 20 + "end"
    row = periodic.periodic_runs(docs_of(spark, [text])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 60, 3)]
    assert row["collapsed"] == "intro a b c end"
