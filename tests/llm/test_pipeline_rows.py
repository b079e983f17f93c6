"""Stages of the pipeline decide by row: on rows without a doc_id, and on rows that share one."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import quality
from tickloom.llm.decontam import contained_items

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def shared_ids(spark, bad):
    """The documents; of the bad ones a third have no doc_id, and a third that of another document which is not bad."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = sorted(r.doc_id for r in docs.select("doc_id").collect() if r.doc_id not in bad)
    new = {i: [i, None, good[n % len(good)]][n % 3] for n, i in enumerate(sorted(bad))}
    ids = spark.createDataFrame(list(new.items()), f"old {dict(docs.dtypes)['doc_id']}, new {dict(docs.dtypes)['doc_id']}")
    chosen = F.when(F.col("old").isNotNull(), F.col("new")).otherwise(F.col("doc_id"))
    return docs.join(ids, docs.doc_id == ids.old, "left").withColumn("doc_id", chosen).select(docs.columns).checkpoint()


def odd_rows(spark):
    """Null and repeated identifiers, null and empty texts, equal rows, and columns that operators use themselves."""
    words = [f"word{i}" for i in range(60)]
    long_, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(None, long_), (None, near), (1, long_.upper()), (2, near), (2, near), (2, "quite another text of some few words"), (3, None), (4, ""), (None, None), (5, long_ + " and more words")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", "1 _id", "2 _y", "'x' kept", "'y' _text", "0 component_id", "1 _row")


def test_odd_rows(spark):
    docs = odd_rows(spark)
    assert set(corpus_pipeline.good(spark, docs, DATA).columns) == set(docs.columns)
    unique = corpus_pipeline.exact(spark, docs, DATA)
    assert unique.columns == docs.columns
    got = Counter((r.doc_id, (r.text or "").lower()) for r in unique.collect())
    want = {}
    for r in docs.collect():
        t = (r.text or "").lower()
        want.setdefault(t, []).append(r.doc_id)
    assert got == Counter((min((i for i in ids if i is not None), default=None), t) for t, ids in want.items())
    near = corpus_pipeline.near(spark, docs, DATA)  # 1, 2 and 5 are one group
    assert Counter(r.doc_id for r in near.collect()) == Counter([None, None, None, 1, 3, 4])
    assert counted(corpus_pipeline.clean(spark, docs, DATA), docs.columns) == counted(docs, docs.columns)
    coded = corpus_pipeline.encode(spark, docs, DATA).collect()
    assert Counter(r.doc_id for r in coded) == Counter(r.doc_id for r in docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0


def counted(frame, columns):
    return Counter(map(tuple, frame.select(columns).collect()))


def test_quality(spark):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    bad = {r.doc_id for r in quality.score(source, quality.train(source, labels)).filter("NOT kept").collect()}
    docs = shared_ids(spark, bad)
    want = quality.score(docs, quality.train(docs, labels), carry=True).filter("kept").select("_row.*")
    assert len(bad) >= 3
    assert counted(corpus_pipeline.good(spark, docs, DATA), docs.columns) == counted(want, docs.columns)


def test_decontamination(spark):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    bad = {r.doc_id for r in contained_items(source, items).collect()}
    want = counted(source.filter(~F.col("doc_id").isin(list(bad))), source.columns)
    assert len(bad) >= 3
    assert counted(corpus_pipeline.clean(spark, shared_ids(spark, bad), DATA), source.columns) == want
