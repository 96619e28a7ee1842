"""Operators on documents against brute force: nulls, empty and long texts, ties, repeats, clashes."""

from __future__ import annotations

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fieldguard.llm import bpe, decontaminate, jaccard, pii, queries, sharding, substring, toxicity

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fixture_texts() -> list[tuple]:
    rnd = random.Random(5)
    said = ["alpha", "Beta", "gämma", "d.e", "x", "日本", "ring", "the", "of", "12"]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = [rnd.choice(said) + str(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 90))]
        if i % 3 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = passage[rnd.randint(0, 20) : rnd.randint(35, 60)]
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(words)))
    base = [f"w{i}" for i in range(120)]
    for i in range(60, 75):  # near copies, some of them linked through others only
        near = list(base)
        for _ in range(rnd.randint(0, 5)):
            near[rnd.randint(0, 119)] = f"edit{rnd.randint(0, 3)}"
        rows.append((i, " ".join(near)))
    rows += [(75, None), (76, ""), (77, " \n"), (78, "one"), (79, "one two"), (80, "ONE"), (81, "same " * 70)]
    rows += [(82, "long" * 5000), (83, " ".join(f"z{i % 700}" for i in range(6000)))]
    rows += [(84, rows[10][1]), (85, rows[10][1]), (10, rows[10][1]), (None, rows[3][1]), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns carry names the operators use themselves."""
    df = spark.createDataFrame(fixture_texts(), "doc_id long, text string").repartition(3)
    for name in ("id", "version", "places", "n", "row", "_row", "ids", "hash", "spans", "base", "_score", "items", "cell"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def empty(docs):
    return docs.where("false")


def brute_repeats(rows, window=20):
    seen: dict[tuple, tuple] = {}
    far = 1 << 62
    texts = [(far if i is None else i, SPACED.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            seen[k] = min(seen.get(k, (far, far)), (i, s))
    out = []
    for i, w in texts:
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        out.append((None if i == far else i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def test_substrings(docs):
    got = sorted(map(tuple, substring.dedup_substrings(docs).collect()), key=str)
    assert got == brute_repeats(fixture_texts())
    assert substring.dedup_substrings(empty(docs)).collect() == []


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = SPACED.findall(lowered(t or ""))
        sets.append((i, {tuple(w[s : s + 3]) for s in range(max(1, len(w) - 2))} if w else set()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if None not in (i, j) and both and 100 * both >= 90 * len(x | y):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted(((i, len(x), None if i is None else root(i)) for i, x in sets), key=str)


def test_jaccard(docs):
    out = jaccard.link_components(docs).select("doc_id", "n_shingles", "component_id")
    got = sorted(map(tuple, out.collect()), key=str)
    want = brute_components(fixture_texts())
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 5
    assert jaccard.link_components(empty(docs)).collect() == []


BENCH = [(1, " ".join(f"P{i}" for i in range(25, 45))), (2, "one"), (3, "!!"), (4, None), (5, "ONE two"), (2, "one"), (10, "p30 p31"), (6, "same " * 10)]


def brute_leaks(rows, items):
    out = []
    cut = [(i, ALNUM.findall(lowered(t or ""))) for i, t in items]
    for i, t in rows:
        w, hit, found = ALNUM.findall(lowered(t or "")), set(), set()
        for item, x in cut:
            size = min(10, len(x))
            windows = {tuple(x[s : s + size]) for s in range(len(x) - size + 1)} if x else set()
            for s in range(len(w) - size + 1):
                if size and tuple(w[s : s + size]) in windows:
                    hit.update(range(s, s + size))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 1])
def test_decontamination(spark, docs, part_bytes):
    """The benchmark in one part, and in a part per item."""
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    out = decontaminate.find_leaks(docs, bench, part_bytes)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_leaks(fixture_texts(), BENCH)
    none = decontaminate.find_leaks(docs, bench.where("false"))
    assert none.where("n_hit > 0 OR size(items) > 0").isEmpty() and none.count() == len(fixture_texts())
    assert decontaminate.find_leaks(empty(docs), bench).collect() == []


@pytest.mark.parametrize("leaf", [24, bpe.LEAF])
def test_bpe(spark, docs, leaf):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.vocabulary())
    rnd = random.Random(1)
    pool = ["a", "é", "é", "ß", "1", "<|endoftext|>", "'s", "!!!", "日本", "İ", " ", "\n", " ", "x" * 40, "\x01", "🎉", "́"]
    hard = [(1000 + i, "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 150)))) for i in range(80)]
    rows = fixture_texts() + hard
    df = docs.select("doc_id", "text").union(spark.createDataFrame(hard, "doc_id long, text string"))
    out = bpe.decode(bpe.encode(df, queries.vocabulary(), leaf), queries.vocabulary())
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = []
    for i, t in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, tool.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    assert bpe.encode(empty(docs), queries.vocabulary(), keep=("id",)).collect() == []


def test_sharding(docs):
    out = sharding.shard(docs).collect()
    rows = fixture_texts()
    assert len(out) == len(rows)
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in out if r.doc_id is not None) == want
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.shard(empty(docs)).collect() == []


def test_slot_map_versions(spark):
    sizes = {s: (s * 37) % 101 + 1 for s in range(256)}
    first = sharding.plan(sizes, 256, 4)
    load = lambda m, k: [sum(sizes[s] for s in m if m[s] == x) for x in range(k)]
    assert max(load(first, 4)) - min(load(first, 4)) <= max(sizes.values())
    stored = sharding.SlotMap.create(spark, first)
    moves = sharding.rebalance(first, sizes, 5)
    assert stored.edit(moves) == 1
    grown = {r.slot: r.shard for r in stored.at().collect()}
    assert {r.slot: r.shard for r in stored.at(0).collect()} == first
    assert {s for s in grown if grown[s] != first[s]} == set(moves)
    # Slots come to the new shard; a few more move to even the old ones, none leaves the new one.
    assert list(moves.values()).count(4) > len(moves) / 2 and len(moves) < 80
    assert not any(first[s] == 4 for s in moves)
    assert max(load(grown, 5)) - min(load(grown, 5)) <= max(sizes.values())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_of_random_texts():
    rnd = random.Random(3)
    pool = ["@", ".", "a", "b-c", "1", "255", "256", " ", "+", "(", ")", "-", "4929348385146306", "é", "+1 (017) 555-7713", "x@y.z", "1.2.3.4", "00012", "\n"]
    for _ in range(3000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == brute_base(text), text


def test_field_adds_what_patterns_miss(spark, docs):
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    model = pii.learn(texts)

    def added(text):
        return [(k, text[b:e]) for k, b, e in model.added(text, pii.base_spans(text))]

    assert added("call 1 (017) 555-7713 then") == [("phone", "1 (017) 555-7713")]
    assert added("+1 (017) 555-7713 233.254.104.120 en") == [("phone", "+1 (017) 555-7713")]
    assert added("mail john.doe at example dot com now") == [("email", "john.doe at example dot com")]
    assert added("au 7536784127813050 4845168114407329 ai") == [("card", "7536784127813050"), ("card", "4845168114407329")]
    for clean in ("thing 4929348385146307 re", "version 300.1.2.3 is", "key 9b0b3c6a43eb78aa99cbd7", "and at the dot of it", ""):
        assert added(clean) == []


def test_pii_frame(spark):
    rows = [(1, "write a.b@c.de or +1 (017) 555-7713"), (2, None), (3, ""), (1, "é 10.0.0.1"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    out = pii.find(df)
    got = {(r.doc_id, r.text): [tuple(s) for s in r.base] for r in out.collect()}
    assert got == {(i, t): brute_base(t or "") for i, t in rows}
    texts = {r.text for r in pii.redact(out).collect()}
    assert texts == {"write [EMAIL] or [PHONE]", None, "", "é [IP]", "x"}
    assert pii.find(df.where("false")).collect() == []


def test_toxicity_frame(spark, docs):
    rude = [(i, f"you {w} and th") for i, w in enumerate(["idiot", "moron"] * 60)]
    fine = [(200 + i, f"this is the text {i} and that") for i in range(300)]
    df = spark.createDataFrame(rude + fine, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in rude + fine] + [(None, 1), (3, None)], "doc_id long, toxic int")
    scorer = toxicity.Scorer.fit(df, labels)
    probe = ["you 1d10t there", "you i d i o t there", "m0r0n", "idiooot", "i.d.i.o.t", "text 5 is", "", None]
    rows = spark.createDataFrame(list(enumerate(probe)), "k int, text string").withColumn("_score", F.lit("x"))
    got = [r["_score"] for r in scorer.score(rows).orderBy("k").collect()]
    assert all(s >= 0.3 for s in got[:5]) and all(s < 0.3 for s in got[5:])
    assert toxicity.score_documents(docs, labels).count() == len(fixture_texts())
    assert toxicity.score_documents(empty(docs), labels.where("false")).collect() == []
