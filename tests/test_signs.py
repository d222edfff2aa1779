"""Queries over whole texts and all components, against plain Python."""

from __future__ import annotations

import random

import pytest
from capstream.functions import scoring
from capstream.plans import catalogue
from pyspark.sql import functions as F


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "_IDS", 16)
    rng = random.Random(9)
    vectors = {i: [rng.uniform(-1, 1) for _ in range(64)] for i in [0, 1, 2, 5, 15, 16, 40, 41, 100, 101, 999]}
    vectors[2] = vectors[1][:32] + [-x for x in vectors[1][32:]]  # the same in the first half only
    vectors[41] = vectors[40]
    spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(30, "a whole text, of which no beginning is taken"), (31, "x" * 5 + " many words follow here")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), vectors


def signs(v):
    return sum(1 << i for i, x in enumerate(v) if x > 0)


def test_neighbours_over_gaps_and_all_components(spark, folder):
    path, vectors = folder
    ids = sorted(vectors)
    got = {r.vec_id: r.distance for r in catalogue.hamming_neighbors(spark, path).collect()}
    assert got == {b: (signs(vectors[a]) ^ signs(vectors[b])).bit_count() / 64 for a, b in zip(ids, ids[1:])}


def test_names_and_reuse_see_all_components(spark, folder):
    path, vectors = folder
    names = {r.vec_id: r.signature for r in catalogue.signature_names(spark, path).collect()}
    assert names[1] != names[2] and names[40] == names[41] and len(set(names.values())) == len(vectors) - 1
    actions = {r.vec_id: (r.action, r.source) for r in catalogue.reuse_chain(spark, path).collect()}
    assert actions[2] == ("call", 2) and actions[41] == ("exact", 40)


def test_words_of_other_lengths(spark):
    for n in (0, 1, 63, 64, 65, 130):
        v = [1.0 if i % 3 else -1.0 for i in range(n)]
        got = spark.createDataFrame([(v,)], "v array<double>").select(catalogue._words(F.col("v")).alias("w")).first().w
        assert [w % 2**64 for w in got] == [signs(v[k : k + 64]) for k in range(0, n, 64)]


def test_whole_texts_are_scored(spark, folder):
    path, _ = folder
    got = {r.doc_id: r.quality for r in catalogue.quality_score(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    q = F.round(scoring.quality(F.col("text"), (F.col("doc_id") * 13 % 50 + 50) / 100, F.col("doc_id") % 3 + 1), 6)
    assert got == {r.doc_id: r.q for r in docs.select("doc_id", q.alias("q")).collect()}
