"""Decoding against every reading; words whose polynomial hashes coincide; repeated query rows; repeated hits."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fieldguard.llm import bpe, decontaminate, jaccard, queries, substring, topk, toxicity


def cost_of(reading, model):
    """Language model cost of letters after three edges, with the closing edge."""
    context, total = toxicity._START, 0.0
    for c in reading:
        code = toxicity._letter(c)
        total += model[context * toxicity.LETTERS + code]
        context = (context * toxicity.LETTERS + code) % toxicity._CONTEXTS
    return total + model[context * toxicity.LETTERS + toxicity.EDGE]


def test_decode_is_the_best_of_all_readings():
    rnd = random.Random(4)
    model = np.random.default_rng(4).gamma(2.0, 2.0, toxicity.LETTERS**4).tolist()
    for n in range(80):
        text = "".join(rnd.choice("ab1@$*!il0oo..") for _ in range(rnd.randint(1, 4)))
        lattice = [toxicity._options(text.lower(), i, toxicity.REPEAT) for i in range(len(text))]
        best = min(
            cost_of([x for x, _ in path if x], model) + sum(c for _, c in path) for path in itertools.product(*lattice)
        )
        found, cost, whole = toxicity._search(text.lower(), model, toxicity.REPEAT, None, math.inf)
        assert whole and abs(cost - best) < 1e-9
        # However narrow the first search, the reading is the exact one.
        kept, toxicity._STATES = toxicity._STATES, 1 + n % 3
        try:
            assert toxicity.decode(text, model) == found
        finally:
            toxicity._STATES = kept


def thue_morse(size):
    """A word of two letters, and its complement: polynomial hashes modulo 2^64 cannot tell them apart."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_colliding_words(spark):
    a, b = thue_morse(2048)
    tail = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{a} {tail}"), (2, " ".join(f"{b} u{i}" for i in range(25))), (3, f"{b}"), (4, f"{a}"), (5, " ".join([a] * 25)), (6, " ".join([b] * 25))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = queries.vocabulary()
    encoder = bpe.Encoder(open(path, encoding="utf-8").read())
    assert {r.doc_id: r.ids for r in bpe.encode(df, path).collect()} == {i: encoder.plain(t) for i, t in rows}
    removed = {r.doc_id: r.n_removed for r in substring.dedup_substrings(df).collect()}
    assert {i: removed[i] for i in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 0} and removed[6] == removed[5] == 24
    parts = {r.doc_id: r.component_id for r in jaccard.link_components(df).collect()}
    assert parts == {i: i for i, _ in rows}


def test_repeated_query_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    twice = df.where("vec_id = 50")
    got = topk.top_k(df, twice.union(twice).union(df.where("vec_id = 100"))).collect()
    one = [tuple(r) for r in topk.top_k(df, df.where("vec_id IN (50, 100)")).collect()]
    assert sorted(map(tuple, got)) == sorted([*one, *[r for r in one if r[0] == 50]])


def test_many_hits_of_one_item(spark):
    docs = spark.createDataFrame([(1, "spam " * 60_000), (2, "ham spam"), (3, "ham")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "spam"), ("j", "spam spam"), ("k", "spam")], "item_id string, text string")
    got = decontaminate.find_leaks(docs, bench).select("doc_id", "n_words", "n_hit", F.sort_array("items").alias("items")).collect()
    assert sorted(map(tuple, got)) == [(1, 60_000, 60_000, ["i", "j", "k"]), (2, 2, 1, ["i", "k"]), (3, 1, 0, [])]


def test_decoding_in_bulk_is_the_librarys():
    encoder = bpe.Encoder(open(queries.vocabulary(), encoding="utf-8").read())
    lists = [[1, 2, 49407], [], None, [320] * 50]
    got = encoder.texts(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [encoder.tokenizer.decode(x or [], skip_special_tokens=False) for x in lists]
