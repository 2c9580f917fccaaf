"""Jaccard join, sentence spans and suffix arrays against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import jaccard, sentences, suffix
from ledgerflow.llm.common import components
from tests.llm.helpers import docs_of, empty_docs, odd_docs, pandas_docs, small


def word_set(t, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).replace("\t", " ").replace("\n", " ").replace(
        "\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def smallest_reachable(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute_components(rows, n, percent):
    sets = [(d, word_set(t, n)) for d, t in rows]
    edges = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    low = smallest_reachable({d for d, _ in sets}, edges)
    return sorted((d, len(x), low[d]) for d, x in sets)


def near_copies(count, seed, words=40, edits=2):
    """Texts in families whose members differ in a few words, with lines shared by all."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    line = " ".join(rng.choices(vocab, k=12))
    out = []
    for _ in range(count // 10):
        base = rng.choices(vocab, k=rng.randint(3, words))
        for _ in range(10):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy) + rng.choice(["", "\n" + line]))
    return out


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 60)])
def test_components_equal_brute_force(spark, n, percent):
    texts = near_copies(200, 3 * n)
    got = jaccard.jaccard_components(docs_of(spark, texts), n, percent)
    assert sorted(map(tuple, got.collect())) == brute_components(enumerate(texts), n, percent)


def test_large_blocks_are_tiled(spark, monkeypatch):
    # one family in many variants, more than several tiles hold; some link only to late members
    monkeypatch.setattr(jaccard, "TILE", 8)
    texts = near_copies(40, 5, words=60, edits=6) + near_copies(10, 6) * 8
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    texts += [" ".join(rng.choice([w, w, w, w, w, w, w, "x"]) if rng.random() < 0.3 else w for w in base) for _ in range(80)]
    got = jaccard.jaccard_components(docs_of(spark, texts), 3, 70)
    assert sorted(map(tuple, got.collect())) == brute_components(enumerate(texts), 3, 70)


def test_tiles_of_long_rows_stay_small(spark, monkeypatch):
    # long rows: few of them in a tile, multiplied a part of the columns at a time
    monkeypatch.setattr(jaccard, "CELLS", 200)
    monkeypatch.setattr(jaccard, "STEP", 50)
    seen, tiles = [], jaccard._tiles

    def look(placed, percent):
        out, read = tiles(placed, percent)
        seen.append(out.groupBy("h", "sa", "sb", "i", "j").sum("n").agg({"sum(n)": "max"}).first()[0])
        return out, read

    monkeypatch.setattr(jaccard, "_tiles", look)
    rng = random.Random(21)
    base = [f"b{k}" for k in range(60)]
    texts = [" ".join(rng.choice([w, w, w, w, w, w, w, "x"]) if rng.random() < 0.3 else w for w in base) for _ in range(80)]
    got = jaccard.jaccard_components(docs_of(spark, texts), 3, 70)
    assert sorted(map(tuple, got.collect())) == brute_components(enumerate(texts), 3, 70)
    assert seen and seen[0] < 1500


def test_a_product_of_long_rows_needs_little_memory():
    rng = np.random.default_rng(1)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 9000)
    t = pa.table({"cls": pa.array(range(200), pa.int64()), "n": pa.array([8000] * 200, pa.int64()), "comp": pa.array(range(200), pa.int64()),
                  "side": pa.array([0] * 200, pa.int32()),
                  "hashes": pa.array([rng.choice(base, 8000, replace=False) for _ in range(200)], pa.list_(pa.int64()))})
    tracemalloc.start()
    try:
        found = jaccard._tile_links(t, 80)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 199 and peak < 60e6


def test_long_rows_that_are_unlike_go_no_further():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2 ** 64 - 1, n, np.uint64)) for n in (6000, 6500, 7000, 8100, 8200, 8300)]
    sets.append(np.unique(np.append(sets[3][:8000], rng.integers(0, 2 ** 64 - 1, 500, np.uint64))))
    t = pa.table({"n": pa.array([len(s) for s in sets], pa.int64()), "comp": pa.array(range(len(sets)), pa.int64()),
                  "side": pa.array([0] * len(sets), pa.int32()), "folded": pa.array([jaccard._folded(s) for s in sets], pa.binary())})
    assert jaccard._possible(t, 80).tolist() == [False, False, False, True, False, False, True]
    assert len({len(jaccard._folded(s)) for s in sets}) == 2
    for x in sets:
        for y in sets:
            assert np.bitwise_count(np.bitwise_xor(*jaccard._same_width([jaccard._folded(x), jaccard._folded(y)]))).sum() <= len(np.setxor1d(x, y))


def test_components_of_small_table(spark):
    rows = [(r.doc_id, r.text) for r in pandas_docs(small(spark)).itertuples()]
    got = jaccard.jaccard_components(small(spark))
    assert sorted(map(tuple, got.collect())) == brute_components(rows, 3, 90)


def test_jaccard_odd_and_empty(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd_docs(spark)).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 4), (5, 1, 5), (6, 1, 5), (8, 1, 8)} <= got
    assert jaccard.jaccard_components(empty_docs(spark)).collect() == []
    kept = jaccard.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_repeated_and_missing_ids(spark):
    """A doc_id's unlike texts are told apart, rows without a doc_id are linked like others."""
    rng = random.Random(17)
    a, b, c, d = (" ".join(rng.choices([f"v{k}" for k in range(900)], k=60)) for _ in range(4))
    rows = [(5, a), (5, b), (5, b), (3, c), (8, c + " tail"), (None, b + " end"), (None, d), (None, d + " more"), (None, d),
            (7, ""), (7, ""), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, _at int, key string")
    kept = jaccard.keep_first(df, 3, 80)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    one = {k for k in got if k[0] is None and k[1] and k[1].startswith(d[:20])}
    assert len(one) == 1 and got[one.pop()] == 1
    assert {k: v for k, v in got.items() if not (k[0] is None and k[1])} == {(5, a): 1, (5, b): 1, (3, c): 1, (7, ""): 2, (None, None): 1}
    linked = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, 3, 80).collect()}
    assert linked == {(5, 58, 5), (3, 58, 3), (8, 59, 3), (None, 59, 5), (None, 58, None), (None, 59, None), (7, 0, 7), (None, 0, None)}


def test_texts_of_one_id_join_components(spark):
    rng = random.Random(23)
    a, b = (" ".join(rng.choices([f"v{k}" for k in range(900)], k=60)) for _ in range(2))
    rows = [(9, a), (5, a + " z"), (5, b), (2, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard.jaccard_components(df).collect()} == {2}
    assert sorted((r.doc_id, r.text) for r in jaccard.keep_first(df).collect()) == [(2, b), (5, a + " z")]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_connected_components(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert {r.id: r.comp for r in components(df).collect()} == smallest_reachable(nodes, [p for p in pairs if p[0] != p[1]])


def brute_sentences(rows):
    places = defaultdict(list)
    found = [(d, t, sentences.runs(t)) for d, t in rows]
    for d, _, rs in found:
        for h, more, a, _, _ in rs:
            places[h, more].append((d, a))
    return {d: sentences.without(t, [(a, b) for h, more, a, b, _ in rs if min(places[h, more]) != (d, a)]) for d, t, rs in found}


def test_sentence_spans_equal_brute_force(spark):
    rng = random.Random(4)
    bank = [" ".join(rng.choices("the of and river stone light winter paper".split(), k=rng.randint(1, 14))).capitalize() + rng.choice(".!?")
            for _ in range(60)]
    passage = " ".join(bank[10:15])
    texts = [" ".join(rng.choices(bank, k=rng.randint(1, 9))) + rng.choice(["", "\n" + passage, "\n\n" + passage + " Tail here."])
             for _ in range(120)]
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in sentences.remove_repeats(docs_of(spark, texts)).collect()}
    assert got == brute_sentences(enumerate(texts))
    assert sum(passage in t for t, _, _ in got.values()) == 1


def test_sentence_cases(spark):
    long = "Alone " + "word " * 60 + "end."
    texts = [long, "Before it. " + long, "Short one. Two.", "Short one. Two.", "", None]
    got = {r.doc_id: r.text for r in sentences.remove_repeats(docs_of(spark, texts)).collect()}
    assert got == {0: long, 1: "Before it. ", 2: texts[2], 3: texts[3], 4: "", 5: ""}
    assert sentences.remove_repeats(odd_docs(spark)).count() == odd_docs(spark).count()
    assert sentences.remove_repeats(empty_docs(spark)).collect() == []


def every_run_gone(texts):
    """Places of the sentences covered by any run, of any length, that an earlier place has too."""
    split = [sentences.sentences(t) for t in texts]
    words = [[tuple(t[a:b].casefold().split()) for a, b in places] for t, places in zip(texts, split)]
    seen, gone = {}, [set() for _ in texts]
    for d, w in enumerate(words):
        for a in range(len(w)):
            for b in range(a, len(w)):
                size = sum(map(len, w[a: b + 1]))
                if (b - a >= 1 and size >= 12) or size >= 40:
                    if seen.setdefault(tuple(w[a: b + 1]), (d, a)) != (d, a):
                        gone[d] |= set(range(a, b + 1))
    return gone


def test_short_ends_of_repeated_runs_go(spark):
    def tell(name, n):
        return " ".join(f"{name}{k}" for k in range(n)) + "."

    a, b, s = tell("a", 45), tell("b", 5), tell("s", 20)
    copy = f"{tell('o', 15)} {s} Thanks. Bye."
    texts = [f"{a} {b} {tell('x', 9)}", f"{a} {b} {tell('y', 9)}", copy, copy, f"{tell('z', 6)} {copy}"]
    got = {r.doc_id: r.text for r in sentences.remove_repeats(docs_of(spark, texts)).collect()}
    assert got == {0: texts[0], 1: tell("y", 9), 2: copy, 3: "", 4: tell("z", 6) + " "}


def test_sentence_spans_equal_every_run(spark):
    rng = random.Random(11)
    bank = [" ".join(rng.choices("the of and river stone light winter paper".split(), k=k)) + "." for k in
            [1, 1, 2, 3, 4, 5, 6, 9, 13, 20, 39, 41, 45]]
    texts = [" ".join(rng.choices(bank, k=rng.randint(1, 8))) for _ in range(40)]
    texts += ["\n".join(f"{k} {rng.random()}." if rng.random() < 0.3 else x for x in rng.choices(bank, k=9)) for k in range(60)]
    got = {r.doc_id: r.text for r in sentences.remove_repeats(docs_of(spark, texts)).collect()}
    gone = every_run_gone(texts)
    assert got == {d: sentences.without(t, [(k, k) for k in gone[d]])[0] for d, t in enumerate(texts)}
    assert sum(map(len, gone)) > 50


def test_rows_without_an_id(spark):
    long = " ".join(f"w{k}" for k in range(45)) + "."
    near = long.replace("w44", "other")
    docs = spark.createDataFrame([(None, long), (None, near), (3, long), (None, "alone it stands"), (4, long)], "doc_id long, text string")
    got = sentences.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, long), (0, near), (0, "alone it stands"), (3, long), (4, "")])
    parts = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs, 3, 90).collect()}
    assert parts == {(None, 3), (None, None), (3, 3), (4, 3)}
    kept = sorted((r.doc_id or 0, r.text) for r in jaccard.keep_first(docs).collect())
    # rows without an id are near copies of document 3, which stays for them
    assert kept == sorted([(0, "alone it stands"), (3, long)])


def brute_suffix(rows, span):
    raws = [(d, (t or "").encode()) for d, t in rows]
    times = Counter(r[i: i + span] for _, r in raws for i in range(len(r) - span + 1))
    out = []
    for d, r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - span + 1):
            if times[r[i: i + span]] > 1:
                gone[i: i + span] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((d, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect()), key=str)


def repeated_texts(seed, count=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé ", k=rng.randint(20, 90))) for _ in range(6)]
    out = ["".join(rng.choice([rng.choice(passages), "".join(rng.choices("abcd ", k=rng.randint(1, 30)))])
                   for _ in range(rng.randint(1, 8))) for _ in range(count)]
    return out + out[:5] + ["a" * 130, "a" * 40, "ab" * 70, "", None]


@pytest.mark.parametrize("group", [4096, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_removal_equals_brute_force(spark, seed, group):
    texts = repeated_texts(seed)
    got = suffix.remove_repeats(docs_of(spark, texts), span=40, gram=12, group=group)
    assert suffix_rows(got) == brute_suffix(enumerate(texts), 40)


def test_suffix_of_small_table(spark):
    rows = [(r.doc_id, r.text) for r in pandas_docs(small(spark)).itertuples()]
    assert suffix_rows(suffix.remove_repeats(small(spark))) == brute_suffix(rows, 400)


def test_suffix_odd_and_empty(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    assert suffix_rows(suffix.remove_repeats(odd_docs(spark))) == brute_suffix(rows, 400)
    assert suffix.remove_repeats(empty_docs(spark)).collect() == []


def test_interval_tree():
    # suffixes of banana in order: a, ana, anana, banana, na, nana
    assert set(suffix.interval_tree([1, 3, 0, 0, 2])) == {(0, 0, 5), (1, 0, 2), (3, 1, 2), (2, 4, 5)}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300).map(lambda b: bytes(x % 2 for x in b)))
def test_anchors_cover_every_window(raw):
    at, h = suffix.anchors(np.frombuffer(raw, np.uint8), 20, 6)
    for i in range(len(raw) - 19):
        assert ((at >= i) & (at <= i + 14)).any()
    for p, x in zip(at, h):
        assert x == suffix.window_hashes(np.frombuffer(raw[p: p + 6], np.uint8), 6).view(np.int64)[0]
