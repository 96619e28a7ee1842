"""Phrase mining against counting everything."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldguard.llm import phrases


def brute(rows, least, most_words, top, percent=100):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, most_words + 1):
                for s in range(len(w) - size + 1):
                    f[lang, tuple(w[s : s + size])] += 1
    out = defaultdict(list)
    longer = Counter()
    for (lang, p), a in f.items():
        if a >= least and len(p) > 2:
            for size in range(2, len(p)):
                for s in range(len(p) - size + 1):
                    q = lang, p[s : s + size]
                    longer[q] = max(longer[q], a)
    for (lang, p), a in f.items():
        if a >= least and len(p) > 1 and not 100 * longer[lang, p] >= percent * a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [
        (lang, i + 1, p.decode(), -a, le, r, n[lang], -score)
        for lang, xs in out.items() for i, (score, a, p, le, r) in enumerate(sorted(xs)[:top])
    ]


def corpus(seed, docs=160):
    rnd = random.Random(seed)
    words = ["The", "the", "Été", "ÉTÉ", "x", "of", "new", "york", "city", "a-b", "漢字", "\x01", "ÿ", " "]
    fixed = ["New York City of the x", "a-b a-b a-b a-b a-b a-b a-b", "of the. of the! of,the", "york\tcity\rof"]
    out = []
    for i in range(docs):
        said = [rnd.choice(words) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 4)):
            said.insert(rnd.randint(0, len(said)), rnd.choice(fixed))
        out.append((i, rnd.choice(" ,  \n   ").join(said), rnd.choice(["en", "en", "und", None, "", "de"])))
    return out + [(None, "new york city new york", "en"), (3, "new york", "de"), (3, "new york", "de"), (500, None, "en"), (501, "", None)]


@pytest.mark.parametrize(
    "how",
    [
        {}, {"bits": 1 << 6}, {"sample": 1 << 40}, {"sample": 1, "lowered": 1.0}, {"sample": 1 << 40, "bits": 1 << 16},
        {"cover_percent": 60, "top": 7}, {"most_words": 3}, {"most_words": 7, "least": 3},
    ],
)
def test_collocations(spark, how):
    rows = corpus(len(str(how)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    df = df.withColumn("phrase", F.lit("x")).withColumn("f", F.lit(2)).withColumn("size", F.lit(None))
    how = {"least": 9, "most_words": 5, "top": 40} | how
    got = [tuple(r) for r in phrases.collocations(df, **how).collect()]
    want = brute(rows, how["least"], how["most_words"], how["top"], how.get("cover_percent", 100))
    assert want and sorted(got) == sorted(want)
    assert phrases.collocations(df.limit(0), **how).collect() == []


def test_long_text_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_PIECE", 50)
    rows = [(1, "one two three " * 4000, "en"), (2, "two three one, " * 30, "en"), (3, "w" * 90_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrases.collocations(df).collect())) == sorted(brute(rows, 100, 5, 2000))


def test_scores_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits with counts that a table can hold; the division stays exact."""
    one = spark.createDataFrame([(10**10 + 7, 10**10 + 9, 3 * 10**13 + 1, 10**13 + 3)], "l long, r long, n long, a long")
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    over = F.lit(1000).cast("decimal(5,0)") * (whole("a") * whole("n")).cast("decimal(38,0)")
    got = one.select(F.expr("1").alias("x"), over.alias("_over"), (whole("l") * whole("r")).alias("_under")).select(F.expr("_over div _under")).first()[0]
    assert got == 1000 * (10**13 + 3) * (3 * 10**13 + 1) // ((10**10 + 7) * (10**10 + 9))
