from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from capstream.llm import op5_simhash as op
from capstream.llm.graph import components

from tests.llm import tables


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, distance):
    root = list(range(len(values)))
    for i, x in enumerate(values):
        for j in range(i):
            if bin(x ^ values[j]).count("1") <= distance:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints():
    for _, text, *_ in tables.rows()["documents"]:
        assert int.from_bytes(op.fingerprint(text)) == slow_fingerprint(text)
    assert op.fingerprint("A b\u00a0c")[:8] == op.fingerprint("a b\u00a0c", lanes=3)[:8]


def groups(spark, values, **kw):
    """Smallest member of each value's component, by the operator."""
    classes = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v, bytearray(v.to_bytes(8, "big"))) for v in sorted(set(values))], "node long, fp binary")
    found = {r.node: r.root for r in components(op.near_links(classes, 64, **kw)).collect()}
    return {v: found.get(s, s) for v in values for s in [v - 2**64 if v >= 2**63 else v]}


def clusters(rng, n):
    base = [int(x) for x in rng.integers(0, 2**63, n)]
    near = [b ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for b in base for _ in range(4)]
    return sorted({*base, *near, 0, 1, 3, 2**64 - 1, 2**64 - 2})


@pytest.mark.parametrize("bucket_rows", [op.BUCKET_ROWS, 3])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_against_all_pairs(spark, monkeypatch, bucket_rows, distance):
    if distance > 2 and bucket_rows < 10:
        pytest.skip("beyond 2 bits, buckets that are too large are searched in salted parts")
    monkeypatch.setattr(op, "BUCKET_ROWS", bucket_rows)
    values = clusters(np.random.default_rng(distance), 40)
    got, want = groups(spark, values, distance=distance), roots(values, distance)
    same = {}
    for v, w in zip(values, want):
        assert same.setdefault(w, got[v]) == got[v]
    assert len(set(got.values())) == len(set(want))


def test_pairs_that_only_meet_in_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 64)
    monkeypatch.setattr(op, "make_plan", lambda *a: [(list(range(k, k + 16)), 0) for k in (0, 16, 32, 48)])
    rng, values = np.random.default_rng(5), []
    for x in rng.integers(0, 2**48, 400).tolist():  # the first part is the same in all, each other one differs by a bit
        values += [x, x ^ sum(1 << (16 * k + int(rng.integers(16))) for k in range(3))]
    got, want = groups(spark, values, distance=3), roots(values, 3)
    assert len({(got[v], w) for v, w in zip(values, want, strict=True)}) == len(set(want)) == len(set(got.values()))


def test_unequal_thresholds_keep_the_pigeonhole():
    cost, chosen = op.allocate([[0, 100, 1000], [0, 1, 5], [0, 2, 50]], 3)
    assert chosen == [-1, 1, 0] and cost == 7
    rng = np.random.default_rng(3)
    sample = [bytes(rng.integers(0, 256, 8, dtype=np.uint8)) for _ in range(300)]
    for distance in range(5):
        plan = op.make_plan(sample, 10**6, 64, distance)
        assert sum(t + 1 for _, t in plan) == distance + 1
        assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)


def test_correlated_bits_come_together():
    rng = np.random.default_rng(4)
    half = rng.integers(0, 2, (500, 4))
    bits = np.concatenate([half, rng.integers(0, 2, (500, 8)), half], axis=1)
    groups_ = op.bit_groups(bits, 4)
    assert sorted(sum(groups_, [])) == list(range(16))
    assert sum(any(b in g and b + 12 in g for g in groups_) for b in range(4)) >= 3


def test_query_against_brute_force(spark, tmp_path):
    folder = tables.write(spark, tmp_path)
    rows = op.op5_simhash(spark, folder).collect()
    docs = tables.rows()["documents"]
    values = [slow_fingerprint(d[1]) for d in docs]
    want = roots(values, 2)
    expect = []
    for d, v, w in zip(docs, values, want):
        ids = [x[0] for x, r in zip(docs, want) if r == w and x[0] is not None]
        expect.append((d[0], f"{v:016x}", min(ids, default=None)))
    assert sorted(map(repr, expect)) == sorted(repr(tuple(r)) for r in rows)


def test_recall_of_near_copies_at_the_pipeline_setting(spark):
    import random

    import corpus_pipeline as p

    rng = random.Random(11)
    docs, pairs = [], []
    for i in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        copy = list(words)
        while True:  # change words until the similarity of five-word shingles is just above 0.8
            trial = list(copy)
            trial[rng.randrange(300)] = "changed"
            a, b = ({tuple(x[k : k + 5]) for k in range(296)} for x in (words, trial))
            if len(a & b) / len(a | b) < 0.8:
                break
            copy = trial
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
        pairs.append((2 * i, 2 * i + 1))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.root for r in op.grouped(df, ["doc_id"], p.SHINGLE, p.DISTANCE, p.LANES, p.PARTS).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert len(set(found.values())) >= 150  # and different documents stay apart


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(-5, -3), (-3, -1), (-1, -5), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1080), 1000), -5: -5, -3: -5, -1: -5}
