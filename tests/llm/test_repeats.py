from __future__ import annotations

import random

import numpy as np
import pytest
from capstream.llm import op7_repeats as op
from capstream.llm.suffixes import suffix_arrays
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=6))
def test_suffix_arrays(texts):
    for text, array in zip(texts, suffix_arrays([np.array(t, np.int64) for t in texts])):
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(docs, length=op.LENGTH):
    docs = [(i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, b in docs:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            least[w] = min(least.get(w, op.NO_ID), op.NO_ID if i is None else i)
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k : k + length]] < (op.NO_ID if i is None else i):
                gone[k : k + length] = b"\1" * length
        runs = bytes(gone).split(b"\0")
        out.append((i, len(b), sum(gone), sum(1 for r in runs if r), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = op.without_repeats(df, **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh \n", "aé漢 ", "x"][seed]
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.randint(40, 160)) for _ in range(5)]
    docs = [(None, None), (7, ""), (8, text(49)), (9, text(50)), (9, text(50)), (None, shared[0] * 2)]
    for i in range(60):
        part = [text(rng.randint(0, 80)) if rng.random() < 0.5 else rng.choice(shared) for _ in range(rng.randint(1, 6))]
        docs.append((i * 3, "".join(part)))
    base = text(400)
    for i in range(25):  # near copies
        at = rng.randrange(380)
        docs.append((1000 - i, base[:at] + text(5) + base[at + 5 :]))
    if seed % 2:
        monkeypatch.setattr(op, "ANCHOR_SYMBOLS", 300)
        monkeypatch.setattr(op, "SLICE_BYTES", 1 << 18)
    assert run(spark, docs, part_bytes=4000 if seed < 3 else 1 << 20) == brute(docs)


def test_copies_go_whole(spark):
    docs = [(i, "the same words over and over again in this long enough text, " * 3) for i in range(40)]
    got = run(spark, docs)
    assert [r[2] for r in sorted(got)] == [0] + [len(docs[0][1])] * 39


def test_contexts_of_one_anchor_are_split_exactly(monkeypatch):
    rng = random.Random(9)
    anchor = bytes(rng.randrange(97, 123) for _ in range(op.K))
    contexts = []
    for i in range(60):
        left = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 24)))
        right = bytes(rng.choice(b"ab") for _ in range(24))
        text = left + anchor + right
        out = np.empty(len(text) - op.LENGTH + 1, np.int64)
        contexts.append((len(left), text, rng.randrange(100), [(out, 0)]))
    least = {}
    for _, text, doc, _ in contexts:
        for k in range(len(text) - op.LENGTH + 1):
            least[text[k : k + op.LENGTH]] = min(doc, least.get(text[k : k + op.LENGTH], 10**9))
    for limit in (10**6, 200):
        monkeypatch.setattr(op, "ANCHOR_SYMBOLS", limit)
        comparer = op.Comparer()
        comparer.add(contexts)
        comparer.flush()
        for _, text, _, [(out, _)] in contexts:
            assert out.tolist() == [least[text[k : k + op.LENGTH]] for k in range(len(text) - op.LENGTH + 1)]
