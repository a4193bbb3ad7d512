"""The pipeline's stages on the given small table and on edge cases."""

import pytest

import corpus_pipeline
from cartwheel.llm.common import documents, written
from tests.conftest import SF_SMALL
from tests.llm.test_queries import near_by_hand, quality_counts


@pytest.mark.parametrize("table", ["small", "edge", "empty"])
def test_stages(spark, edge_dir, empty_dir, table):
    folder = {"small": SF_SMALL, "edge": edge_dir, "empty": empty_dir}[table]
    docs = documents(spark, folder)
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, folder), "test_stage")
        if name != "encode":
            assert docs.columns == columns
        kept[name] = (before.collect(), docs.collect())
    if table == "empty":
        assert kept["encode"][1] == []
        return
    before, after = kept["quality"]
    assert sorted(repr(r) for r in after) == sorted(repr(r) for r in before if not quality_counts(r.text)[5])
    before, after = kept["near_dedup"]
    found = near_by_hand([(r.doc_id, r.text, None, None) for r in before])
    groups = {c for _, n, c in found if n}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted((c is None, c or 0) for c in groups)
    _, after = kept["encode"]
    assert len(after) == len(kept["mix"][1])
    assert sorted(r.decoded for r in after) == sorted((r.text or "").replace("▁", " ") for r in kept["mix"][1])
    assert all(r.n_tokens == len(r.token_ids) for r in after)
