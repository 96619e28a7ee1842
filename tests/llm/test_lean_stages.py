"""The pipeline's stages keep what a task holds small, however they are called."""

from __future__ import annotations

import corpus_pipeline
from fieldguard.sources.bindings import table

DIR = "/root/testdata/sf0.001"


def test_every_stage_sets_them_itself(spark):
    before = {name: spark.conf.get(name, None) for name in corpus_pipeline.LEAN}
    docs = table(spark, DIR, "documents").limit(3)
    try:
        for _, stage in corpus_pipeline.STAGES[1:]:
            for name in before:
                spark.conf.unset(name)
            stage(spark, docs, DIR)
            assert {name: spark.conf.get(name) for name in before} == corpus_pipeline.LEAN
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
