"""The pipeline and the registered queries on the smallest tables."""

import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from altigrid.llm import common, mixing
from altigrid.llm.common import saved
from altigrid.llm.queries import llm_oracles, llm_queries
from check_oracles import compare, open_tables
from tests.conftest import SMALL


def test_all_are_registered():
    assert len(llm_queries()) == 13 and set(llm_queries()) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_beside_its_sql(spark, name):
    assert compare(spark, open_tables(SMALL), SMALL, name) is None


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    start = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, SMALL)
        assert after.columns == start.columns, name
        rows = after.collect()
        assert 0 < len(rows) <= docs.count() and len({r.doc_id for r in rows}) == len(rows)
        if k != 2:
            before = {r.doc_id: r.text for r in docs.collect()}
            assert all(before[r.doc_id] == r.text for r in rows)
        docs = spark.createDataFrame(rows, start.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_sequences_follow_the_mix_through_files(spark):
    """The mix stage's order, written and read again, is the order in which sequences are numbered."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    place = {r.doc_id: (r._slot, r._place) for r in mixing.mix(docs).collect()}
    mixed = saved(stages["mixing sources to target weights"](spark, docs, SMALL))
    packed = stages["best-fit packing"](spark, mixed, SMALL).collect()
    first = {}
    for r in packed:
        at = (*place[r.doc_id], r.piece)
        first[r.sequence_id] = min(first.get(r.sequence_id, at), at)
    order = [first[s] for s in sorted(first)]
    assert len(order) > 1 and order == sorted(order)


def test_workers_hand_back_memory(monkeypatch):
    """After the last batch, and where another operator's cache is emptied."""
    released = []
    monkeypatch.setattr(common, "release", lambda: released.append(True))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b"]})
    assert sum(b.num_rows for b in common.small_batches([batch, batch.slice(0, 0)], "text", 5)) == 3 and len(released) == 1
    monkeypatch.setattr(common, "_HELD", {"first": released.clear})
    common.hold("first", lambda: None)
    assert len(released) == 1
    common.hold("second", lambda: None)
    assert len(released) == 2 and list(common._HELD) == ["second"]
    monkeypatch.undo()
    common.release()
