"""The registered queries and the pipeline against brute force."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerflow.llm import pii, quality
from ledgerflow.llm.common import cut
from tests.llm.helpers import SMALL, empty_docs, odd_docs, small
from tests.llm.test_duplicates import brute_components
from tests.llm.test_search import brute_leaks

NUMBERS = range(1, 14)


def test_every_operator_has_one_query():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(NUMBERS)
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_decide_as_brute_force(spark):
    docs = small(spark)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = cut(stage(spark, docs if not out else last, SMALL), "t")
        last = out[name]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert [(f.name, f.dataType) for f in last.schema] == [(f.name, f.dataType) for f in small(spark).schema]
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(docs, small(spark, "labels"))
    good = {r.doc_id for r in quality.score_documents(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in out["quality classifier"].collect()} == good
    kept = {d for d, _, c in brute_components([(d, rows[d]) for d in sorted(good)], 5, 80) if d == c}
    assert {r.doc_id for r in out["n-gram Jaccard join"].collect()} == kept
    items = [(r.item_id, r.text) for r in small(spark, "benchmark").collect()]
    leaked = {d for d, _ in brute_leaks([(d, rows[d]) for d in kept], items)}
    assert {r.doc_id for r in out["benchmark decontamination"].collect()} == kept - leaked
    masked = {r.doc_id: (r.text, r.n_chars) for r in out["personal data"].collect()}
    assert masked == {d: (pii.mask(rows[d]), len(pii.mask(rows[d]))) for d in kept - leaked}
    packed = out["best-fit packing"].collect()
    assert {r.doc_id for r in packed} == kept - leaked
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.piece, bytes(r.ids)) for r in run.collect()) == sorted((r.doc_id, r.piece, bytes(r.ids)) for r in packed)


@pytest.mark.parametrize("make", [odd_docs, empty_docs])
def test_stages_take_odd_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SMALL), "odd")
        assert docs.columns == make(spark).columns
    corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_entry_works_without_the_folder(tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("ledgerflow", "__spark_entry__.py"):
        os.symlink(os.path.join(root, name), tmp_path / name)
    code = ("import sys; sys.modules['ledgerflow.llm'] = None\nimport __spark_entry__ as e\n"
            "assert not [q for q in e.queries() if q.startswith('op') and q[2].isdigit()]; print(len(e.queries()))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
