"""Fixtures shared by the tests of the text operators."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

#: Null, empty, blank, tied, repeated, long and odd texts.
ODD = [(0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "one two"), (5, "same words here"), (6, "same words here"),
       (6, "same words here"), (7, "x" * 5000), (8, "ab " * 3000), (9, "Ünïcödé Σας ﬁ 中文 \x1f end\u0085line"),
       (10, "<|endoftext|> it's"), (None, "no id at all"), (None, None)]


def odd_docs(spark):
    """The odd texts, with extra columns whose names operators use themselves."""
    rows = [(d, t, "en", "s", len(t or ""), 7, "clash", 0.5, True) for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `rank` int, "
                                       "spans string, score double, ids boolean")


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")


def small(spark, name="documents"):
    return spark.read.parquet(os.path.join(SMALL, f"{name}.parquet"))


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*[F.col(c) for c in columns]).collect()), key=lambda r: tuple((x is None, str(x)) if not isinstance(x, (int, float)) else (False, f"{x:030.9f}") for x in r))


def pandas_docs(df):
    return df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).toPandas()
