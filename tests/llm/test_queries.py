"""Registered queries of the training-data operators against their SQL, on the smallest tables."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from fieldguard.llm import queries
from tools.check import TABLES, clean, key

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    link = duckdb.connect()
    for t in TABLES:
        link.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return link


@pytest.mark.parametrize("name", queries.SQL)
def test_same_rows(spark, con, name):
    df = queries.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = [tuple(clean(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    rel = con.sql(queries.SQL[name])
    at = [rel.columns.index(c) for c in columns]
    want = [tuple(clean(r[i]) for i in at) for r in rel.fetchall()]
    assert sorted(rel.columns) == columns
    assert sorted(got, key=key) == sorted(want, key=key)


def test_bpe_is_the_librarys(spark, con):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.vocabulary())
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op10_bpe"](spark, DIR).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc_id, text in con.sql("SELECT doc_id, text FROM documents").fetchall():
        ids = tool.encode(text or "", add_special_tokens=False).ids
        decoded = tool.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic").collect()}
    rows = queries.QUERIES["op3_toxicity"](spark, d).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    known = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    hit = sum(1 for y, p in known if y and p)
    assert hit / max(1, sum(p for _, p in known)) > 0.85
    assert hit / sum(y for y, _ in known) > 0.8
