"""Quality ranking and toxicity machine: held-out accuracy, contracts, odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import quality, toxicity
from tests.llm.helpers import empty_docs, odd_docs, small

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    return (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("make,label,least", [(quality.quality_scores, "quality", 0.97),
                                              (toxicity.toxicity_scores, "toxic", 0.85)])
def test_held_out_accuracy(spark, make, label, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = make(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.toPandas().merge(labels.toPandas(), on="doc_id", how="left")
    assert len(rows) == docs.count()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]
    assert rows.score.between(0, 1).all()
    cut = 0.5 if label == "quality" else toxicity.THRESHOLD
    assert (rows.predicted == (rows.score >= cut)).all()
    test = rows[rows.held_out & rows[label].notna()]
    assert auc(test.score.to_numpy(), test[label].to_numpy()) >= least


@pytest.mark.parametrize("make,label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_held_out_labels_do_not_matter(spark, make, label):
    docs, labels = small(spark), small(spark, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    renamed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "n_chars": F.lit(0)})
    assert sorted(map(tuple, make(docs, labels).collect())) == sorted(map(tuple, make(renamed, other).collect()))


@pytest.mark.parametrize("make,label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_odd_texts_and_missing_labels(spark, make, label):
    kind = "doc_id long, quality int, toxic int, score double"
    none = spark.createDataFrame([], kind)
    one = spark.createDataFrame([(d, 1, 0, 0.1) for d in range(8)], kind)
    both = spark.createDataFrame([(d, d % 2, d % 2, None) for d in range(8)] + [(None, 1, 1, 0.0), (3, None, None, 0.0),
                                                                                (5, 0, 0, 0.2)], kind)
    for labels in (none, one, both):
        rows = make(odd_docs(spark), labels).collect()
        assert len(rows) == odd_docs(spark).count()
        assert all(0 <= r.score <= 1 for r in rows)
        same = [r.score for r in rows if r.doc_id in (5, 6)]
        assert len(set(same)) == 1
        assert make(empty_docs(spark), labels).collect() == []


def test_ranking_threshold_is_the_quantile_of_bad_documents():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(2, 1, (60, 3)), rng.normal(-2, 1, (20, 3))])
    y = np.repeat([1, 0], [60, 20])
    m = quality.fit(x, y)
    assert (m.score(x) < 0.5).sum() == 20


def test_machine_learns_a_pair_that_single_terms_do_not_show():
    # toxic only where both terms are present; each alone is as common in clean documents
    active = [np.array(a, np.int64) for a in ([[0, 1]] * 40 + [[0]] * 60 + [[1]] * 60 + [[]] * 60)]
    y = np.repeat([1.0, 0, 0, 0], [40, 60, 60, 60])
    m = toxicity.fit(active, y, {10: 0, 20: 1})
    both, first, second, none = m.score([np.array(a, np.int64) for a in ([0, 1], [0], [1], [])])
    assert both > 0.7 and max(first, second, none) < 0.3


def test_accept_keeps_columns_and_order_of_decisions(spark):
    docs, labels = small(spark), small(spark, "labels")
    model = quality.train(docs, labels)
    kept = quality.accept(docs, model)
    assert kept.schema == docs.schema
    good = {r.doc_id for r in quality.score_documents(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good
