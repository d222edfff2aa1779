from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from capstream.llm import op6_sharding as op
from pyspark.sql import functions as F

from tests.llm import tables


def test_matrix_rows_and_columns_are_exact():
    rng = np.random.default_rng(1)
    for _ in range(30):
        counts = rng.integers(0, 500, 12).tolist()
        room = op.capacities(sum(counts), 7)
        matrix = op.communication_matrix(counts, room, 3)
        assert [sum(r) for r in matrix] == counts
        assert [sum(c) for c in zip(*matrix)] == room


def test_draws_follow_the_law():
    rng = np.random.default_rng(2)
    got = Counter(op.hypergeometric(rng, 6, 9, 5) for _ in range(20000))
    from math import comb

    for k in range(6):
        want = 20000 * comb(6, k) * comb(9, 5 - k) / comb(15, 5)
        assert abs(got[k] - want) < 6 * (want + 1) ** 0.5
    big = [op.hypergeometric(rng, 10**11, 3 * 10**11, 10**9) for _ in range(50)]
    assert abs(np.mean(big) - 2.5e8) < 1e4 and 5e3 < np.std(big) < 3e4


def test_shards_are_even_and_slots_without_gaps(spark, tmp_path):
    folder = tables.write(spark, tmp_path)
    rows = op.op6_sharding(spark, folder).collect()
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(24)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    again = op.op6_sharding(spark, folder).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_order_is_shuffled_and_copies_spread(spark, monkeypatch):
    monkeypatch.setattr(op, "PARTITION_ROWS", 100)
    monkeypatch.setattr(op, "STRETCH_ROWS", 20)
    df = spark.range(3000).withColumn("x", F.when(F.col("id") < 1000, -1).otherwise(F.col("id")))
    rows = op.shard_rows(df, [F.col("x")], 10, keep=("id", "x")).collect()
    per = Counter(r.shard for r in rows)
    assert set(per.values()) == {300}
    copies = Counter(r.shard for r in rows if r.x == -1)
    assert min(copies.values()) > 60 and max(copies.values()) < 145
    for s in range(10):
        own = sorted((r.slot, r.id) for r in rows if r.shard == s)
        assert [k for k, _ in own] == list(range(300))
        rise = sum(a[1] < b[1] for a, b in zip(own, own[1:]))
        assert 100 < rise < 200


def test_columns_against_plain_python(spark, tmp_path):
    got = sorted(repr((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard)) for r in op.op6_sharding(spark, tables.write(spark, tmp_path)).collect())
    data = [(d[0], (d[1] or "").encode()) for d in tables.rows()["documents"]]
    assert got == sorted(repr((i, len(t) + 8, zlib.crc32(t), "rows", None)) for i, t in data)


def test_copies_of_a_row_leave_its_partition(spark, monkeypatch):
    monkeypatch.setattr(op, "PARTITION_ROWS", 100)
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))
    dealt = rows.select(F.struct("x").alias("kept"), F.xxhash64("x").alias("draw")).withColumn("part", F.pmod("draw", F.lit(40)))
    spread = op._spread(dealt, dict(dealt.groupBy("part").count().collect()), 4000, 40)
    counts = [r["count"] for r in spread.groupBy("part").count().collect()]
    assert sum(counts) == 4000 and max(counts) < 200
    assert op._spread(dealt.where("kept.x >= 0"), dict(dealt.where("kept.x >= 0").groupBy("part").count().collect()), 2666, 40) is None


def test_names_that_clash(spark, tmp_path):
    df = spark.range(50).select("id", F.col("id").alias("Shard"), F.lit("x").alias("slot"))
    op.shard_rows(df, [F.col("id")], 5, keep=("id", "Shard", "slot")).write.parquet(f"{tmp_path}/out")
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert all(r.Shard == r.id and r.slot == "x" for r in rows) and Counter(r._shard for r in rows) == dict.fromkeys(range(5), 10)
