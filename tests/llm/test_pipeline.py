"""The pipeline and the registered queries on the smallest tables, against plain Python and SQL."""

import re

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tamarack.llm.common import written
from tamarack.llm.queries import QUERIES, SQL
from tests.llm.conftest import ODD
from tests.llm.test_ledger_pieces import spans
from tests.llm.test_search import groups, shingles
from tools.check import connect, rows_of


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, data, name):
    frame = QUERIES[name](spark, data)
    result = connect(data).execute(SQL[name])
    want = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(want)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(want, result.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_stages_against_brute_force(spark, data):
    con = duckdb.connect()
    items = [t for (t,) in con.execute(f"SELECT text FROM '{data}/benchmark.parquet'").fetchall()]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = {r["doc_id"]: r for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        columns = docs.columns
        docs = written(stage(spark, docs, data), "test-stage")
        rows = docs.collect()
        kept = {r["doc_id"]: r for r in rows}
        assert len(kept) == len(rows) and kept.keys() <= before.keys()
        if k < 4:
            assert docs.columns == columns
        if k == 1:
            want = groups([(i, r["text"]) for i, r in before.items()])
            assert kept.keys() == {i for i, (_, c) in want.items() if c == i}
        if k == 2:
            leaks = lambda t: any(100 * len(shingles(q) & shingles(t)) >= 75 * len(shingles(q)) for q in items)
            assert kept.keys() == {i for i, r in before.items() if not leaks(r["text"])}
        if k == 3:
            assert kept.keys() == before.keys()
            for i, r in kept.items():
                changed = r["text"] != before[i]["text"]
                assert changed == bool(spans(before[i]["text"])) and not spans(r["text"]) and r["n_chars"] == len(r["text"])
        if k == 4:
            assert kept.keys() == before.keys() and docs.columns[: len(columns)] == columns
            for r in rows:
                assert r["n_tokens"] == len(model.encode(r["text"], add_bos=True, add_eos=True))
        if k in (0, 3):
            assert all(r[c] == before[i][c] for i, r in kept.items() for c in ("lang", "source"))


def test_odd_rows_pass_all_stages(spark, docs_of, data):
    docs = docs_of(ODD)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, data), "odd-stage")
    rows = docs.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i in (1, 2, 3, 4, 6, 7, 8, 9, None))
    assert all(r["score"] == 7 for r in rows)
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, data), "empty-stage")
    assert empty.count() == 0


def test_a_task_leaves_its_worker_tidy():
    """Arrays in reference cycles are gone when a task of any stage ends, not only when the worker's next task begins."""
    import gc
    import weakref

    import numpy as np

    from tamarack.llm import containment, jaccard, pieces, toxicity
    from tamarack.llm.common import tidied

    left = []

    @tidied
    def task(batches):
        class Held:
            data = np.zeros(1000)

        held = Held()
        held.own = held
        left.append(weakref.ref(held))
        yield from batches

    gc.disable()
    try:
        assert list(task(iter([1, 2]))) == [1, 2]
        assert left[0]() is None
    finally:
        gc.enable()
    for run in (jaccard._first_pass, jaccard._array_batches, containment._mark_batches, toxicity._score_batches, pieces._encode_batches):
        assert run.__wrapped__
