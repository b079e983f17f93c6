"""The pipeline against brute force, stage by stage, each on what the one before kept."""

import hashlib
import os
import re

import pytest

import corpus_pipeline
from tickloom.llm import queries as llm_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def low(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def grams(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near(docs):
    """Smallest identifier of each group of linked documents."""
    sets = {i: grams(re.findall(r"[^\x20\x09-\x0D]+", low(t))) for i, t in docs.items()}
    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for group in by.values():
        for j in group:
            for i in group:
                if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    return {i for i in docs if find(i) == i}


def clean(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    wanted = [g for g in (grams(words(t)) for t in items) if g]
    return {i for i, t in docs.items() if not any(len(g & grams(words(t))) >= 0.8 * len(g) for g in wanted)}


def test_stages(spark, tmp_path):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    docs, seen = source, {r.doc_id: r.text for r in source.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = {r.doc_id: r for r in docs.collect()}
        if name == "byte_bpe":
            assert rows.keys() == seen.keys()
            assert all(r.decoded_sha256 == hashlib.sha256(seen[i].encode()).hexdigest() and len(r.ids) == 4 * r.n_tokens for i, r in rows.items())
            continue
        assert docs.columns == source.columns
        if name == "quality":
            right = [(i in rows) == bool(q) for i, q in quality.items() if i in seen]
            assert sum(right) >= 0.95 * len(right)
        elif name == "exact_dedup":
            first = {}
            for i in sorted(seen):
                first.setdefault(low(seen[i]), i)
            assert rows.keys() == set(first.values())
        elif name == "near_dedup":
            assert rows.keys() == near(seen)
        else:
            assert rows.keys() == clean(seen, items)
        seen = {i: r.text for i, r in rows.items()}


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    frame = llm_queries.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(map(plain, r)) for r in frame.select(*columns).collect())
    want = c.sql(llm_queries.oracle_sql()[name])
    at = [list(want.columns).index(x) for x in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
