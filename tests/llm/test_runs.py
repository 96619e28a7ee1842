"""Words put together from runs of letters and signs come out as the library encodes them."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldguard.llm import bpe, queries

FILE = open(queries.vocabulary(), encoding="utf-8").read()
ENCODER = bpe.Encoder(FILE)
PIECES = ["the", "Ing", "HELLO", "é", "É", "ÿ", "ſ", "İ", "ŉ", "ß", "é", "'s", "'T", "'", "<", ".", "!!", "~", "`"]
PIECES += ["[", "_", "-", "9", "42", "²", "\xa0", "\x01", "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "µ", "×", "  ", "\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES) | st.characters(max_codepoint=0x17F), max_size=12), max_size=4))
def test_runs(texts):
    said = ["".join(x) for x in texts]
    ids, ends = ENCODER.batch(pa.array(said, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [ENCODER.plain(x) for x in said]


def test_memories_are_bounded():
    known = {i: i for i in range(10)}
    assert bpe.recent(known, 10) is known
    assert list(bpe.recent(known, 9)) == [5, 6, 7, 8, 9]


def test_only_the_proven_settings():
    assert bpe.by_kind(FILE)
    other = json.loads(FILE)
    other["normalizer"]["normalizers"] = other["normalizer"]["normalizers"][:2]
    assert not bpe.by_kind(json.dumps(other))
    other = json.loads(FILE)
    other["added_tokens"][0]["content"] = "the"
    assert not bpe.by_kind(json.dumps(other))
    encoder = bpe.Encoder(FILE)
    encoder.by_kind = False
    ids, _ = encoder.batch(pa.array(["Hello, world!! naïve"]))
    assert np.array_equal(ids, ENCODER.plain("Hello, world!! naïve"))
