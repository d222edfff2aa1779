from __future__ import annotations

import random

from capstream.llm import op10_toxicity as op

from tests.llm.tables import WORDS


def corpus(n, rng):
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(20, 120))]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grobian", "blorkish", "blorkest", "vile"]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(3000, random.Random(1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = {r.doc_id: r for r in op.score(frame, op.train(frame, known)).collect()}
    truth = dict(labels)
    test = [i for i in truth if rows[i].held_out]
    assert 200 < len(test)
    right = sum(rows[i].predicted == truth[i] for i in test)
    assert right / len(test) > 0.97
    positives = [i for i in test if truth[i]]
    assert sum(rows[i].predicted for i in positives) / len(positives) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    kept = {r.doc_id for r in op.without_toxic(frame, op.train(frame, known)).collect()}
    assert kept == {i for i, r in rows.items() if not r.predicted}


def test_held_out_labels_and_texts_are_not_learnt_from(spark):
    docs, labels = corpus(400, random.Random(2))
    import zlib

    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    one, two = (op.train(frame, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert one.weights == two.weights and one.bias == two.bias


def test_no_positives_and_no_labels(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None)]):
        model = op.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(r.predicted == 0 for r in op.score(frame, model).collect())


def test_risk_is_not_driven_below_zero():
    import numpy as np

    rng = np.random.default_rng(3)
    positive = [rng.choice(200, 20, replace=False).astype(np.uint32) for _ in range(20)]
    unlabelled = [rng.choice(200, 20, replace=False).astype(np.uint32) for _ in range(60)]
    model = op.fit(positive, unlabelled, 0.2)
    assert np.isfinite(model.bias) and all(np.isfinite(w) for w in model.weights.values())


def test_fit_against_the_plain_risk():
    """The same steps down the risk, with dense matrices and the risk's gradient by finite differences."""
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.choice(40, (70, 12)).astype(np.uint32)
    positive = [np.unique(np.append(r, [100 + i % 3, 100 + i % 2])).astype(np.uint32) for i, r in enumerate(base[:20])]
    unlabelled = [np.unique(np.append(r, [100] if i % 9 == 0 else [])).astype(np.uint32) for i, r in enumerate(base[20:])]
    prior, soft = 0.3, lambda z: np.logaddexp(0, z)
    model = op.fit(positive, unlabelled, prior)
    ids = list(model.weights)
    xp, xu = (np.array([[1.0, *(i in s for i in ids)] for s in map(set, (x.tolist() for x in sets))]) for sets in (positive, unlabelled))

    def part(w, which):
        corrected = soft(xu @ w).mean() - prior * soft(xp @ w).mean()
        return corrected if which == "corrected" else prior * soft(-xp @ w).mean() + corrected

    w, m, v, clipped = np.append(np.log(prior / (1 - prior)), np.zeros(len(ids))), 0.0, 0.0, 0
    for t in range(1, op.EPOCHS + 1):
        back = part(w, "corrected") < 0
        clipped += back
        units = np.eye(len(w)) * 1e-6
        grad = np.array([(part(w + u, "corrected" if back else "all") - part(w - u, "corrected" if back else "all")) / 2e-6 for u in units])
        grad = (-op.STEP_BACK * grad if back else grad) + op.DECAY * np.append(0, w[1:])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - op.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert clipped and len(ids) >= 3
    texts = np.concatenate([xp, xu])
    assert np.allclose(texts @ w, texts @ np.append(model.bias, list(model.weights.values())), atol=0.05)
