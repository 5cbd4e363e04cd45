"""The pipeline: each stage against a plain version on its own input, and awkward tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from edges import edge_docs, no_docs
from minekit.functions.storage import settle
from minekit.llm.decontamination import Decontamination
from test_decontamination import brute as passages
from test_neardup import brute as components
from test_packing import check

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not present")


def test_stages_on_the_smallest_set(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, DATA), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns and docs.subtract(before).isEmpty()
    toxic = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("toxic = 1").collect()}
    before, after = ({r.doc_id for r in d.collect()} for d in seen["toxicity"])
    assert len(before - after - toxic) <= 0.1 * len(before)
    before, after = seen["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {d for d, (_, c) in components(rows, 5).items() if c == d}
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert gone == {r.doc_id for r in Decontamination().matches(before, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    exact = {r.doc_id for r in before.collect() if any(t in r.text for _, t in items)}
    assert exact <= gone
    some = [(r.doc_id, r.text[:600]) for r in before.limit(8).collect()]
    assert {d for d, _ in passages(some, items[:8])} <= gone | {d for d, _ in some}
    check(docs.collect(), 2048)
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in seen["packing"][0].collect()}


def test_awkward_tables(spark):
    for docs in (edge_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = settle(stage(spark, docs, DATA), name)
            if name != "packing":
                assert after.columns == docs.columns
                docs = after
