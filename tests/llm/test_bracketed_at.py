"""Addresses whose only sign is a bracketed "at"."""

from __future__ import annotations

from fieldguard.llm import pii


def test_bracketed_at_without_digits(spark):
    known = [(i, f"write to name{i % 7}.x{i}@host{i % 5}.com or so") for i in range(200)]
    said = {
        900: ("mail jane.doe[at]example.com for it", "jane.doe[at]example.com"),
        901: ("mail jane (at) example.org for it", "jane (at) example.org"),
        902: ("mail jane{AT}example.com for it", "jane{AT}example.com"),
        903: ("mail mary.jane.van.der.doe [at] post.example.org for it", "mary.jane.van.der.doe [at] post.example.org"),
        904: ("look at it (at noon) or [at] all", None),
        905: ("look at it", None),
    }
    df = spark.createDataFrame(known + [(i, t) for i, (t, _) in said.items()], "doc_id long, text string")
    found = pii.find(df)
    got = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.spans] for r in found.where("doc_id >= 900").collect()}
    assert got == {i: [("email", x)] if x else [] for i, (_, x) in said.items()}
    assert found.where("doc_id >= 900 AND size(base) > 0").isEmpty()
    left = {r.doc_id: r.text for r in pii.redact(found).where("doc_id >= 900").collect()}
    assert left == {i: t.replace(x, "[EMAIL]") if x else t for i, (t, x) in said.items()}
