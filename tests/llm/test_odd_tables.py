"""Every query over tables of odd rows, and over empty ones."""

from __future__ import annotations

import corpus_pipeline
import pytest
from capstream.llm import op2_decontaminate, op10_toxicity, registry

from tests.llm import brute, tables

KEYS = {"op1_topk": None, "op2_decontaminate": None, "op3_chat": "conversations", "op9_links": "pages"}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return tables.write(spark, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables.write(spark, tmp_path_factory.mktemp("empty"), empty=True)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_odd_rows(spark, odd, name):
    got = registry.QUERIES[name](spark, odd).collect()
    source = KEYS.get(name, "documents")
    if source == "conversations":
        assert len(got) == len({r[0] for r in tables.rows()[source]}) + 1
    elif source:
        assert len(got) == len(tables.rows()[source])
        key = "page_id" if source == "pages" else "doc_id"
        assert sorted(map(repr, (r[key] for r in got))) == sorted(map(repr, (r[0] for r in tables.rows()[source])))
    else:
        assert got


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_empty_tables(spark, empty, name):
    got = registry.QUERIES[name](spark, empty).collect()
    assert len(got) == (1 if name == "op3_chat" else 0)


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    corpus_pipeline.run(spark, odd).write.parquet(f"{tmp_path}/out")  # the tables have columns shard and size of their own
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    kept = {r.doc_id for r in got}
    assert len(got) > 60 and 47 not in kept  # holds a benchmark item
    assert not {44, 45} & kept  # copies of 4
    assert {r._shard for r in got} == set(range(24)) and all(r.shard is None for r in got)
    for s in range(24):
        own = sorted(r.slot for r in got if r._shard == s)
        assert own == list(range(len(own)))
    assert not any(r.text and "vile troll" in r.text for r in got)


def test_pipeline_against_brute_force(spark, odd):
    """All stages once more in plain Python, on the classifier's scores."""
    docs = sorted(((d[0], d[1], d[3]) for d in tables.rows()["documents"]), key=lambda d: (d[0] is None, d[0] or 0))
    model = op10_toxicity.train(spark.read.parquet(f"{odd}/documents.parquet"), spark.read.parquet(f"{odd}/labels.parquet"))
    docs = [d for d in docs if model.score(d[1]) < 0.5]
    root = brute.near_groups([d[1] for d in docs])
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    items = [b[1] for b in tables.rows()["benchmark"] if b[1]]
    docs = [d for d in docs if not any(brute.holds(d[1], item, op2_decontaminate) for item in items)]
    _, order = brute.mixed(docs)
    got = corpus_pipeline.run(spark, odd).collect()
    assert sorted(repr((r.doc_id, brute.n_words(r.text))) for r in got) == sorted(repr((docs[i][0], n)) for i, n in order)


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
