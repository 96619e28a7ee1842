"""Toxicity's decoding does no work twice, and what it leaves out changes no reading."""

from __future__ import annotations

import math

import numpy as np

from fieldguard.llm import toxicity
from fieldguard.llm import words as W


def _model() -> np.ndarray:
    return np.random.default_rng(5).uniform(0.1, 6.0, toxicity._CELLS).astype(np.float32)


def test_forms_of_a_word_share_a_search(monkeypatch):
    searched, search = [], toxicity._search
    monkeypatch.setattr(toxicity, "_search", lambda text, *rest: searched.append(text) or search(text, *rest))
    restorer = toxicity.Restorer(_model())
    for said in ("Hello", "hello", "HELLO", "hello,", "Hello."):
        restorer.one(said.encode(), toxicity.MAYBE)
    assert len(searched) == 2  # as it stands, and with letters meant twice


def test_single_way_equals_whole_search():
    model = _model().tolist()
    for text in ("plain", "hello", "h3llo", "a.b.c.d", "x", "", "émile", "no!!", "w*rd  .", "aa11bb "):
        free, cost, whole = toxicity._search(text, model, toxicity.REPEAT, None, math.inf)
        bound, same, _ = toxicity._search(text, model, toxicity.REPEAT, None, cost + 1e-9)
        assert whole and (free, cost) == (bound, same)


def test_places_without_numbers():
    data = np.frombuffer("two words and anothér ".encode(), np.uint8)
    offsets = np.array([0, 6, len(data)])
    full, bare = W.find_words(data, offsets, W.SPACED), W.find_words(data, offsets, W.SPACED, numbered=False)
    for name in ("start", "end", "doc", "counts"):
        assert getattr(full, name).tolist() == getattr(bare, name).tolist()
