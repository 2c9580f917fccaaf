"""Hard negatives against a full scan, and the cover tree's invariants."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import negatives
from ledgerflow.llm.queries import ORACLE, op12_cover_tree_negatives
from tests.llm.helpers import SMALL

FIELDS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def full_scan(rows, every=5, k=5, m=3):
    """The definition, for rows (vec_id, label, integer vector), all different."""
    out = []
    for a, la, x in rows:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, lb) for i, lb, y in rows if i != a and len(x) == len(y))
        for ps, p in [(-s, i) for s, i, lb in scored if lb == la][:k]:
            near = [(-s, i) for s, i, lb in scored if lb != la and 50 * ps <= -100 * s <= 95 * ps][:m]
            out += [(a, p, r, i, ps, s) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, every=5, **how):
    df = spark.createDataFrame([(i, [c / 256 for c in v], lb, 0, "x") for i, lb, v in rows],
                               "vec_id long, embedding array<double>, label int, akey int, score string")
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **how).select(*FIELDS).collect())


def made(seed, n, dim, centres, spread, labels=3):
    r = np.random.default_rng(seed)
    c = r.normal(0, 100, (centres, dim))
    at = r.integers(0, centres, n)
    v = np.rint(c[at] + r.normal(0, spread, (n, dim))).astype(int)
    return [(k, int(r.integers(0, labels)), v[k].tolist()) for k in range(n)]


@pytest.mark.parametrize("seed,n,dim,centres,spread", [(1, 150, 4, 5, 30), (2, 200, 16, 8, 20), (3, 120, 2, 3, 3), (4, 150, 8, 1, 0), (5, 60, 1, 20, 50)])
def test_full_scan(spark, seed, n, dim, centres, spread):
    rows = made(seed, n, dim, centres, spread)
    want = full_scan(rows)
    assert run(spark, rows) == want
    assert want or centres == 1


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "CHUNK", 8)
    monkeypatch.setattr(negatives, "LEAF", 2)
    rows = made(6, 300, 6, 12, 25)
    assert run(spark, rows, every=3) == full_scan(rows, every=3)


def test_equal_vectors_and_ties(spark):
    rows = [(k, k % 2, [10, 0]) for k in range(40)] + [(100 + k, k % 2, [8, k % 3]) for k in range(30)]
    assert run(spark, rows) == full_scan(rows)


def test_tree_covers_its_rows_and_skips_far_ones():
    rows = made(9, 2000, 8, 40, 4, labels=2)
    tree = negatives.CoverTree(*[np.array([r[k] for r in rows], t) for k, t in ((0, np.int64), (1, np.int64), (2, np.float64))])
    v, top = tree.v, tree.top
    x = np.column_stack([v, np.sqrt(np.maximum(0, top ** 2 - (v * v).sum(axis=1)))]) / top

    def below(n):
        return tree.rows[n] if tree.children[n] is None else np.concatenate([below(c) for c in tree.children[n]])

    assert sorted(below(0).tolist()) == list(range(2000))
    for n, children in enumerate(tree.children):
        mine = below(n)
        assert np.arccos(np.clip(x[mine] @ x[tree.centre[n]], -1, 1)).max() <= tree.radius[n] + 1e-6
        if children is not None:
            assert tree.centre[n] in tree.centre[children]  # nesting
    met = 0
    for i, label, q in rows[::50]:
        one = negatives.Query(tree, i, label, np.array(q, np.float64), False)
        top_score = max(int(np.dot(q, r[2])) for r in rows)
        got = one.best(3, 0.5 * top_score, 0.9 * top_score, [])
        scores = sorted(((int(np.dot(q, r[2])), -r[0]) for r in rows if r[1] != label and 0.5 * top_score <= np.dot(q, r[2]) <= 0.9 * top_score), reverse=True)
        assert [(int(s), i_) for s, i_ in got] == scores[:3]
        met += one.met
    assert met < 0.3 * 2000 * len(rows[::50])  # most leaves are never read


def test_found_before_bounds_the_next_block():
    rows = made(10, 1000, 4, 20, 5)
    tree = negatives.CoverTree(*[np.array([r[k] for r in rows], t) for k, t in ((0, np.int64), (1, np.int64), (2, np.float64))])
    q = np.array(rows[0][2], np.float64)
    alone, bounded = (negatives.Query(tree, 0, rows[0][1], q, True) for _ in range(2))
    alone.best(5, -np.inf, np.inf, [])
    best = [(float(q @ q) * 10, -k) for k in range(5)]
    assert bounded.best(5, -np.inf, np.inf, best) == sorted(best, reverse=True)
    assert bounded.met == 0 < alone.met


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (1, [0.75, 0.0], 2), (2, [nan, 1.0], 2), (3, [inf, 1.0], 2), (4, None, 2),
         (6, [0.9, 0.0], None), (None, [0.9, 0.0], 2), (7, [0.75, None], 2), (8, [0.75, 0.0, 0.0], 2), (9, [0.75, 0.1], 3), (10, [], 1), (11, [], 1),
         (12, [], 2)], "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label")).select(*FIELDS).collect())
    s, n = 256 * 256, 256 * 192
    assert got == [(0, 5, 1, 1, s, n), (0, 5, 2, 9, s, n), (5, 0, 1, 1, s, n), (5, 0, 2, 9, s, n), (10, 11, 1, 12, 0, 0)]
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 5 == 0, F.col("label")).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(FIELDS)} FROM ({ORACLE['op12_cover_tree_negatives']})").fetchall())
    got = sorted(tuple(r) for r in op12_cover_tree_negatives(spark, SMALL).select(*FIELDS).collect())
    assert got == want


def test_queries_go_down_a_tree_together():
    rows = made(11, 600, 8, 15, 20)
    ids, labels, v = (np.array([r[k] for r in rows], t) for k, t in ((0, np.int64), (1, np.int64), (2, np.float64)))
    tree = negatives.CoverTree(ids, labels, v)
    at = np.arange(0, 600, 4)
    for same, low, high in ((True, -np.inf, np.inf), (False, 0.0, 40_000.0)):
        all_ = negatives.Queries(tree, ids[at], labels[at], v[at], same)
        shape = (1, len(at), 5)
        scores, found = np.full(shape, -np.inf), np.zeros(shape, np.int64)
        w, q, s, i = all_.best(5, np.full(shape[:2], low), np.full(shape[:2], high), scores, found)
        for x, a in enumerate(at):
            product = v @ v[a]
            ok = ((labels == labels[a]) == same) & (ids != a) & (product >= low) & (product <= high)
            want = sorted(zip((-product[ok]).tolist(), ids[ok].tolist()))[:5]
            assert [(-s_, i_) for s_, i_ in zip(scores[0, x].tolist(), found[0, x].tolist()) if s_ > -np.inf] == want
            assert sorted((-s_, i_) for s_, i_ in zip(s[q == x].tolist(), i[q == x].tolist())) == want


def test_the_search_is_dealt_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    seen, search = [], negatives._search

    def look(pairs, k, same):
        seen.append(pairs.rdd.getNumPartitions())
        return search(pairs, k, same)

    monkeypatch.setattr(negatives, "_search", look)
    rows = made(12, 200, 4, 8, 25)
    assert run(spark, rows) == full_scan(rows)
    assert len(seen) == 2 and min(seen) >= 8
