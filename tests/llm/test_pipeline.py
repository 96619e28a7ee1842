"""The corpus pipeline against brute-force versions of its stages."""

from __future__ import annotations

import corpus_pipeline as pipeline
from fieldguard.llm import pii, queries, toxicity
from fieldguard.session import settle
from tests.llm.test_documents import brute_base, brute_leaks
from tests.llm.test_near_copies import brute_kept

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    stages = dict(pipeline.STAGES)
    seen = []
    for name, stage in stages.items():
        made = settle(stage(spark, docs, DIR))
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in made.collect()}
        seen.append(name)
        assert set(after) <= set(before)
        if name == "toxicity":
            scores = toxicity.score_documents(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()
            assert set(after) == {r.doc_id for r in scores if not r.predicted}
        elif name == "near duplicates":
            assert set(after) == brute_kept([(i, r.text) for i, r in before.items()])
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
            leaks = brute_leaks([(i, r.text) for i, r in before.items()], bench)
            assert set(after) == {i for i, _, hit, _ in leaks if not hit}
        elif name == "personal data":
            assert set(after) == set(before)
            for i, r in after.items():
                assert r.n_chars == len(r.text)
                if not brute_base(before[i].text) and not any(c in before[i].text for c in "0123456789@"):
                    assert r.text == before[i].text
                assert not [s for s in brute_base(r.text) if s[0] in ("email", "card", "phone")]
        else:
            from tokenizers import Tokenizer

            tool = Tokenizer.from_file(queries.vocabulary())
            for i, r in after.items():
                assert r.ids == tool.encode(before[i].text or "", add_special_tokens=False).ids
            assert set(after) == set(before)
        if name != "encoding":
            assert made.columns == list(pipeline.COLUMNS)
        docs = made
    assert 4 <= len(seen) <= 5
    assert pii.KINDS == ("email", "ip", "card", "phone")


def test_hard_rows(spark):
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (2, "", None, None, 0), (None, "text of no id", "en", "s", 13), (3, "a b c " * 4000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.where("false")):
        for _, stage in pipeline.STAGES:
            df = settle(stage(spark, df, DIR))
    for _, stage in pipeline.STAGES:
        docs = settle(stage(spark, docs, DIR))
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "2", "3", "None"]
