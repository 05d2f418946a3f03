"""Every stage of the pipeline against brute force, each over what the stage before it left."""

from __future__ import annotations

import pytest

import corpus_pipeline
from crawldelta.llm import quality
from crawldelta.llm.scratch import stored
from tests.llm.test_operators import components_of, plain_cut, plain_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of each stage."""
    docs, told = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        left = stored(stage(spark, docs, SF), name)
        told[name] = docs.collect(), left.collect()
        docs = left
    return told


def kept(stages, name):
    before, after = stages[name]
    ids = [r.doc_id for r in after]
    assert len(ids) == len(set(ids)) and {r for r in after} <= set(before)
    return before, set(ids)


def test_low_quality_goes(spark, stages):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    before, ids = kept(stages, "quality_classifier")
    assert ids == {r.doc_id for r in quality.quality_report(docs, labels).where("predicted = 1").collect()} and len(ids) < len(before)


def test_exact_copies_go(stages):
    before, ids = kept(stages, "exact_dedup")
    last = {}
    for r in before:
        last[r.text] = max(r.doc_id, last.get(r.text, r.doc_id))
    assert ids == set(last.values()) and len(ids) < len(before)


def test_one_of_each_group_of_fingerprints_stays(stages):
    before, ids = kept(stages, "simhash_near_dedup")
    assert ids == set(components_of([(r.doc_id, plain_simhash(r.text)) for r in before]))


def test_documents_with_a_benchmark_item_go(spark, stages):
    before, ids = kept(stages, "benchmark_decontamination")
    items = [plain_cut(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = set()
    for r in before:
        own = plain_cut(r.text)
        if not any(i and len(i & own) / len(i) >= 0.8 - 1e-9 for i in items):
            clean.add(r.doc_id)
    assert ids == clean and len(ids) < len(before)


def test_what_is_left_is_encoded_whole(stages):
    before, after = stages["sentencepiece"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before) and all(r.round_trip for r in after)


def test_the_stages_in_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
