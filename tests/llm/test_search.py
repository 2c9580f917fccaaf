"""Decontamination, personal data and top-k search against brute force."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, pii, topk
from ledgerflow.llm.queries import ORACLE
from tests.llm.helpers import SMALL, docs_of, empty_docs, odd_docs, pandas_docs, small

# --- decontamination


def words(t):
    return [w for w in re.split(r"[\W_]+", t.lower()) if w]


def five(w):
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)}


def brute_leaks(docs, items):
    """Best window similarity of every item and document that share a shingle, where 0.8 or more."""
    sets = {i: (words(t), five(words(t))) for i, t in items if len(words(t)) >= 5}
    df = {}
    for _, s in sets.values():
        for g in s:
            df[g] = df.get(g, 0) + 1
    top, out = math.log1p(len(sets)), {}
    weight = {g: math.log1p(len(sets) / n) for g, n in df.items()}
    for d, t in docs:
        w = words(t)
        for i, (item, s) in sets.items():
            if not s & five(w):
                continue
            best = 0.0
            for at in range(max(1, len(w) - len(item) + 1)):
                own = five(w[at: at + len(item)])
                best = max(best, sum(weight[g] for g in s & own) / (sum(weight[g] for g in s) + top * len(own - s)))
            if best >= decontaminate.SIMILARITY:
                out[d, i] = round(best, 9)
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"v{k}" for k in range(900)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(4, 60)))) for k in range(25)]
    docs = []
    for d in range(120):
        body = rng.choices(vocab, k=rng.randint(0, 120))
        if d % 3 == 0:
            leak = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, 2)):
                leak[rng.randrange(len(leak))] = "changed"
            at = rng.randint(0, len(body))
            body = body[:at] + leak + body[at:]
        docs.append((d, rng.choice([str.upper, str])(rng.choice([" ", ", ", "\n"]).join(body))))
    benchmark = spark.createDataFrame(items + [(90, None), (91, ""), (92, "too short")], "item_id long, text string")
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark)
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = brute_leaks(docs, items)
    assert found == pytest.approx(want)
    assert len(want) > 15


def test_cut_off_leaks_equal_brute_force(spark):
    # the last or first words differ, so that the fingerprints lie up to twenty bits apart
    rng = random.Random(8)
    vocab = [f"v{k}" for k in range(20_000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(60, 150)))) for k in range(40)]
    docs = []
    for d in range(400):
        w = items[rng.randrange(40)][1].split()
        other = rng.choices(vocab, k=int(len(w) * rng.uniform(0.04, 0.11)))
        w = w[: len(w) - len(other)] + other if d % 2 else other + w[len(other):]
        docs.append((d, " ".join(rng.choices(vocab, k=10) + w + rng.choices(vocab, k=10))))
    docs += [(1000 + k, " ".join(rng.choices(vocab, k=100))) for k in range(20)]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = brute_leaks(docs, items)
    assert found == pytest.approx(want)
    assert sum(0.8 <= x < 0.9 for x in want.values()) > 150


def test_leaks_of_small_table(spark):
    docs = [(r.doc_id, r.text) for r in pandas_docs(small(spark)).itertuples()]
    items = [(r.item_id, r.text) for r in small(spark, "benchmark").collect()]
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(small(spark), small(spark, "benchmark")).collect()}
    assert found == pytest.approx(brute_leaks(docs, items))


def test_fingerprints_within_the_radius_share_a_piece(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, decontaminate.BLOCKS - 1)):
            b ^= 1 << bit
        rows.append((a - (1 << 63), b - (1 << 63)))
    df = spark.createDataFrame(rows, "a long, b long")
    both = df.select(F.size(F.array_intersect(decontaminate.pieces(F.col("a")), decontaminate.pieces(F.col("b")))).alias("n"))
    assert both.where("n = 0").count() == 0


def test_leak_cases_and_native_plan(spark):
    benchmark = small(spark, "benchmark")
    assert decontaminate.leaks(odd_docs(spark), benchmark).count() == 0
    assert decontaminate.leaks(empty_docs(spark), benchmark).count() == 0
    assert decontaminate.leaks(small(spark), benchmark.limit(0)).count() == 0
    item = benchmark.first().text
    rows = [(1, item), (1, item), (2, "x " * 50 + item.upper()), (3, None), (4, item[: len(item) // 2])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, item_id int")
    assert {r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()} == {1, 2}
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]
    plan = decontaminate.leaks(docs, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_leaks_of_rows_without_an_id(spark):
    benchmark = small(spark, "benchmark")
    item = benchmark.first().text
    rows = [(None, "before it " + item), (None, "a text of its own without any leak"), (None, None), (5, "another " + item), (6, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id is None, r.doc_id) for r in decontaminate.leaks(docs, benchmark).collect()) == [(False, 5), (True, None)]
    assert {r.text for r in decontaminate.clean(docs, benchmark).collect()} == {"a text of its own without any leak", None, "fine"}


# --- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_pattern(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.-+ 2_%09(é5", max_size=40))
def test_plain_spans_equal_the_patterns(t):
    assert pii.plain_spans(t) == by_pattern(t)


def test_plain_spans_of_small_table(spark):
    rows = pandas_docs(small(spark))
    want = {r.doc_id: ",".join(f"{k}:{a}:{b}" for a, b, k in by_pattern(r.text)) for r in rows.itertuples()}
    for r in pii.pii_digest(small(spark)).collect():
        assert r.base_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert set(filter(None, want[r.doc_id].split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [r.spans.count(f"{k}:") for k in pii.KINDS]


@pytest.mark.parametrize("text,kind,shown", [
    ("mail jane.doe (at) example (dot) org today", "email", "jane.doe (at) example (dot) org"),
    ("mail jane.doe[at]example[dot]co[dot]uk!", "email", "jane.doe[at]example[dot]co[dot]uk"),
    ("write to jane at example dot com please", "email", "jane at example dot com"),
    ("jаne@exаmple.com is here", "email", "jаne@exаmple.com"),  # Cyrillic a
    ("jane＠example．com here", "email", "jane＠example．com"),
    ("host １０.0.0.1 up", "ip", "１０.0.0.1"),
    ("card four one one one one one one one one one one one one one one one end", "card",
     "four one one one one one one one one one one one one one one one"),
    ("card 4111​1111​1111​1111 ok", "card", "4111​1111​1111​1111"),
    ("call plus four four two zero seven nine four six zero nine five eight now", "phone",
     "plus four four two zero seven nine four six zero nine five eight"),
    ("call +1 555 double two one 0199 x", None, None),
])
def test_disguises_map_back_to_source(text, kind, shown):
    plain, spans = pii.all_spans(text)
    assert not [s for s in plain if s[2] == kind]
    if kind is None:
        assert spans == plain
    else:
        assert [(text[a:b], k) for a, b, k in spans] == [(shown, kind)]
        assert pii.mask(text) == text.replace(shown, f"<{kind}>")


@pytest.mark.parametrize("text,base,shown,kind", [
    ("to j\u0430ne@example.com now", "ne@example.com", "j\u0430ne@example.com", "email"),
    ("to jane@example.c\u043em now", "jane@example.c", "jane@example.c\u043em", "email"),
    ("host \uff1192.168.1.1 up", "92.168.1.1", "\uff1192.168.1.1", "ip"),
    ("call +44 20 7946 095\uff18 x", "+44 20 7946 095", "+44 20 7946 095\uff18", "phone"),
])
def test_disguised_spans_wider_than_plain_ones(spark, text, base, shown, kind):
    plain, spans = pii.all_spans(text)
    assert [text[a:b] for a, b, _ in plain] == [base]
    assert {(text[a:b], k) for a, b, k in spans} == {(base, kind), (shown, kind)}
    assert pii.mask(text) == text.replace(shown, f"<{kind}>")
    row = pii.pii_digest(docs_of(spark, [text])).first()
    assert (row[f"n_{kind}"], row[f"base_{kind}"]) == (2, 1)


@pytest.mark.parametrize("shown", [
    "john [at] example dot com", "john at example (dot) com", "jane dot doe at example dot com", "john@example dot com",
    "jane dot doe (at) example.com", "jane (dot) doe at mail.example dot co [dot] uk", "john at example\uff0ecom",
])
def test_mixed_at_and_dot_forms(shown):
    text = f"write, {shown}, today"
    assert [(text[a:b], k) for a, b, k in pii.all_spans(text)[1]] == [(shown, "email")]
    assert pii.mask(text) == "write, <email>, today"


def test_mixed_forms_beside_plain_spans():
    text = "jane dot doe@example.co dot uk"
    plain, spans = pii.all_spans(text)
    assert plain == [(9, 23, "email")] and spans == [(0, 30, "email"), *plain] and pii.mask(text) == "<email>"


@pytest.mark.parametrize("text", ["look at example.com", "call me at noon dot", "the dot at example.com is blue",
                                  "seen at www.example.com (a) dot", "555 double two one"])
def test_words_beside_plain_hosts_are_left_alone(text):
    assert pii.all_spans(text) == ([], [])


def test_mixed_forms_take_linear_time():
    for t in ("a dot " * 40_000, "a at b." * 30_000, "a.b" * 60_000 + " at ", "a at b dot " * 20_000, "a@b dot " * 30_000, "x dot a@" * 30_000):
        pii.all_spans(t)


@pytest.mark.parametrize("text", ["we met at noon. dot the i", "one two three", "look at this dot", "at dot at dot",
                                  "zero one two three", "Привет мир, как дела", "Ωμέγα και Άλφα", "a (at) b"])
def test_ordinary_text_is_left_alone(text):
    assert pii.all_spans(text) == ([], []) and pii.mask(text) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"ab1@. (at)dot４е​+2", " at ", " dot ", "one ", "two "]), max_size=30).map("".join))
def test_plain_spans_always_stay(t):
    plain, spans = pii.all_spans(t)
    assert set(plain) <= set(spans)
    assert all(0 <= a < b <= len(t) for a, b, _ in spans)


def test_long_adverse_texts_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "-" * 200_000, "a@" * 100_000, "one " * 50_000):
        pii.all_spans(t)


def test_pii_odd_and_empty(spark):
    assert pii.pii_digest(odd_docs(spark)).count() == odd_docs(spark).count()
    assert pii.pii_digest(empty_docs(spark)).collect() == []
    docs = spark.createDataFrame([(1, "a@b.co x", "spans"), (2, None, None)], "doc_id long, text string, spans string")
    assert [tuple(r) for r in pii.redact(docs).orderBy("doc_id").collect()] == [(1, "<email> x", "spans"), (2, None, None)]


# --- top-k search


def test_top_k_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    want = con.sql(ORACLE["op10_threshold_top_k"]).fetchall()
    got = topk.top_k(small(spark, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


def brute_top(rows, every, k):
    ok = [(i, np.floor(256 * np.array(v, np.float64))) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % every == 0:
            best = sorted((-int(q @ v), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k_ties_copies_and_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", 3)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(120, 200)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (204, [0.0] * 4), (205, [1.0, 2.0]), (206, [3.0, -2.0]), (207, []), (210, [-1.0] * 4)]
    df = spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<float>, query_id string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 5)


def test_top_k_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(0, 1, (4000, 3)))
    block = topk.Block(np.arange(4000), v, 5)
    for q in v[:20]:
        ids, score = block.top(q, -1, 5)
        assert sorted(score, reverse=True) == sorted(v @ q, reverse=True)[:5]
    assert block.met < 20 * 4000 / 4


def test_top_k_carried_score_skips_and_loses_nothing():
    rng = np.random.default_rng(2)
    v = np.floor(256 * rng.normal(0, 1, (3000, 8)))
    far, near = topk.Block(np.arange(3000), v, 5), topk.Block(np.arange(3000, 6000), np.floor(v / 100), 5)
    for q in v[:10]:
        want = sorted(far.v @ q, reverse=True)[:5]
        assert sorted(near.top(q, -1, 5, want[-1])[1]) == [] and near.met == 0
        # rows that tie with the carried score are still found
        assert sorted(far.top(q, -1, 5, want[-1])[1], reverse=True) == want


def test_top_k_of_a_table_given_twice(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "CHUNK", 4)
    rng = random.Random(11)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    twice = spark.createDataFrame(rows * 2, "vec_id long, embedding array<float>").repartition(3)
    got = topk.top_k(twice, F.col("vec_id") % 5 == 0, 5)
    for i, own in rows[::5]:
        q = np.floor(256 * np.array(own, np.float32).astype(float))
        # both rows of a query answer together, each with both rows of a candidate
        best = sorted(-int(q @ np.floor(256 * np.array(v, np.float32).astype(float))) for j, v in rows * 4 if j != i)
        assert sorted(-r.score for r in got.where(F.col("query_id") == i).collect()) == best[:5]


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(docs_of(spark, ["a"]).selectExpr("doc_id AS vec_id", "array(1.0f) AS embedding"),
                      F.col("vec_id") % 50 == 0).collect() == []
