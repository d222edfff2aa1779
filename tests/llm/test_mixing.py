from __future__ import annotations

import re
from collections import defaultdict

import pytest
from capstream.llm import op4_mixing as op
from pyspark.sql import functions as F

from tests.llm import brute, tables
from tests.llm.brute import targets


def frame(spark, docs):
    return spark.createDataFrame([(d[0], d[1], d[3]) for d in docs], "doc_id long, text string, source string")


@pytest.mark.parametrize("most", [op.MAX_BROADCAST, 0])
def test_targets_and_what_is_taken(spark, monkeypatch, most):
    monkeypatch.setattr(op, "MAX_BROADCAST", most)
    docs = tables.rows()["documents"]
    got = op.mix(frame(spark, docs)).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += words(d[1])
    want = targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, 0.02 * t)
    again = op.mix(frame(spark, docs).repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_schedule_spreads_every_source_evenly(spark):
    docs = spark.createDataFrame([(i, "w " * 50, "abc"[i % 3]) for i in range(600)], "doc_id long, text string, source string")
    plan = op.source_plan(op.sized(docs, 4))
    slots = op.schedule(plan).orderBy("time").collect()
    per = {r.no: r for r in plan.collect()}
    assert len({r.time for r in slots}) == len(slots)
    for no, source in per.items():
        own = [r for r in slots if r.no == no]
        assert len(own) == source.slots
        assert [r.rank for r in own] == list(range(source.slots))
        assert all(r.block_no == r.rank % source.blocks and r.epoch == r.rank // source.blocks for r in own)
        half = sum(r.time < 2 ** (source.bits - 1) for r in own)
        assert abs(half - source.slots / 2) <= 2  # low discrepancy: any half of the time has half of the slots


@pytest.mark.parametrize("most", [op.MAX_BROADCAST, 0])
def test_texts_of_the_mix(spark, monkeypatch, most):
    monkeypatch.setattr(op, "MAX_BROADCAST", most)
    monkeypatch.setattr(op, "MAX_SLOTS", most)
    docs = frame(spark, tables.rows()["documents"])
    counts = {}
    for r in op.mix(docs).collect():
        counts[r.doc_id, r.size] = counts.get((r.doc_id, r.size), 0) + r.taken
    mixed = op.mixed_texts(docs, ("doc_id", "source", "text"))
    for r in mixed.groupBy("doc_id").agg(F.sum(op.word_count(F.col("text"))).alias("n")).collect():
        assert r.n == sum(v for (d, _), v in counts.items() if d == r.doc_id)
    whole = {(d[0], d[1]) for d in tables.rows()["documents"]}
    for r in mixed.collect():
        assert any(d == r.doc_id and t and t.startswith(r.text) for d, t in whole)


def test_bits_are_reversed(spark):
    row = op.reversed_bits(spark.range(0, 200).withColumn("x", F.col("id") * 7919), "x").collect()
    for r in row:
        assert r.x % 2**64 == int(f"{r.id * 7919:064b}"[::-1], 2)


def test_mix_and_its_order_word_by_word(spark):
    docs = [(d[0], d[1], d[3]) for d in tables.rows()["documents"] if d[0] != 45]
    stats, order = brute.mixed(docs)
    got = {repr((r.doc_id, r.size)): (r.taken, r.first_slot, r.last_slot) for r in op.mix(frame(spark, tables.rows()["documents"]).where("doc_id is null or doc_id != 45")).collect()}
    want = {repr((d[0], brute.n_words(d[1]))): tuple(stats.get(i, (0, -1, -1))) for i, d in enumerate(docs)}
    assert got == want
    rows = op.mixed_texts(frame(spark, tables.rows()["documents"]).where("doc_id is null or doc_id != 45"), ("doc_id", "text")).collect()
    assert [(r.doc_id, brute.n_words(r.text)) for r in rows] == [(docs[i][0], n) for i, n in order]


def test_another_schedule_is_another_mix(spark, monkeypatch):
    docs = frame(spark, tables.rows()["documents"])
    slots = lambda: {(r.doc_id, r.size): (r.first_slot, r.last_slot) for r in op.mix(docs).collect()}
    order = lambda: [r.doc_id for r in op.mixed_texts(docs, ("doc_id", "text")).collect()]
    one = slots(), order()
    monkeypatch.setattr(op, "reversed_bits", lambda rows, name: rows.withColumn(name, F.expr(f"shiftleft({name}, 64 - bits)")))  # one source after another
    two = slots(), order()
    assert one[0] != two[0] and one[1] != two[1] and sorted(map(repr, one[1])) == sorted(map(repr, two[1]))
