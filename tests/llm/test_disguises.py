"""Disguises that plain text could hold as well, each the only sign in its document."""

from __future__ import annotations

import pytest

from fieldguard.llm import toxicity

FORMS = {
    "doubled": ["stuupid", "idiiot", "Stuppid"],
    "closing sign": ["a$$", "idio+", "naz!", "idio+.", "(a$$)"],
    "three letters": ["a s s", "A S S"],
    "wide blanks": ["i   d   i   o   t", "a    s    s", "s     t u p     i d"],
}
PLAIN = ["letter", "three letters!", "as", "idea +", "x y z", "a   b   c", "good$", "C++", "12345"]


@pytest.fixture(scope="module")
def scorer(spark):
    rude = [(i, f"you {w} and th") for i, w in enumerate(["idiot", "stupid", "nazi", "ass"] * 60)]
    fine = [(400 + i, f"this is the text {i} and that good three letters as x") for i in range(500)]
    df = spark.createDataFrame(rude + fine, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 400)) for i, _ in rude + fine], "doc_id long, toxic int")
    return toxicity.Scorer.fit(df, labels)


def test_forms_are_scored(spark, scorer):
    said = [x for form in FORMS.values() for x in form] + PLAIN
    rows = spark.createDataFrame([(i, f"text {x} th") for i, x in enumerate(said)], "k int, text string")
    got = {said[r.k]: r["_score"] for r in scorer.score(rows).collect()}
    assert {x for x in said if got[x] >= toxicity.THRESHOLD} == set(said) - set(PLAIN)


def test_words_as_they_stand_stay(scorer):
    restorer = toxicity.Restorer(scorer.model.value)
    for said in ("letter", "stupid!", "a s s", "kill!!"):
        kind = toxicity.SPELLED if " " in said else toxicity.MAYBE
        assert said in restorer.one(said.encode(), kind).decode()
