"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; everything else, labelled or not, is unlabelled. A linear
classifier over words and beginnings of words is trained with numpy on the class-prior-corrected risk
    prior * R(positive, as 1) + max(0, R(unlabelled, as 0) - prior * R(positive, as 0)),
stepping back up wherever the corrected part turns negative. Fitting sees a bounded sample
(MAX_POSITIVE toxic and MAX_UNLABELLED other rows, smallest hash first); scoring sees every document,
whole. The prior is counted over all labelled rows that may be learnt from.

Rows whose crc32(doc_id as text) mod 5 is 0 are held out: neither their labels nor their texts are
learnt from. Score inputs are the words of the text alone.

Scale: the sample is fitted in one task of an executor, and only the model's MAX_FEATURES weights reach the
driver; scoring is one pass without a shuffle.

Null text and text without words get the score of no features at all. Null doc_id counts as held out.
Repeated rows are scored each. Without a single learnable positive everything scores the prior.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import table

FOLDS = 5
MAX_POSITIVE, MAX_UNLABELLED = 3000, 6000
#: Lengths of the beginnings of words that are features besides the whole words.
PREFIXES = (3, 4, 5, 6)
MIN_POSITIVE, MAX_FEATURES, MIN_LIFT = 3, 4096, 2.0
EPOCHS, RATE, DECAY, STEP_BACK = 400, 0.1, 1e-4, 0.5
STRIP = ".,;:!?\"'()[]{}<>|*#$%&-_/\\~`=+"


def word_features(word: str) -> set[int]:
    """Hashes of a word and its beginnings."""
    word = word.strip(STRIP)
    parts = {"=" + word} | {word[:n] for n in PREFIXES if len(word) >= n}
    return {zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in parts} if word else set()


def text_features(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for word in set((text or "").lower().split()):
        found |= word_features(word)
    return np.fromiter(found, np.uint32, len(found))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_features(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), pa.array(found, pa.binary())], names=["doc_id", "positive", "features"])


class Model:
    """A bias and a weight for some hashes."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights
        self._silent: set[str] = set()
        self._loud: dict[str, frozenset[int]] = {}

    def score(self, text: str | None) -> float:
        hit: set[int] = set()
        for word in set((text or "").lower().split()) - self._silent:
            known = self._loud.get(word)
            if known is None:
                known = frozenset(word_features(word) & self.weights.keys())
                memory = self._loud if known else self._silent
                if len(memory) > 1_000_000:
                    memory.clear()
                if known:
                    self._loud[word] = known
                else:
                    self._silent.add(word)
            hit |= known
        z = self.bias + sum(self.weights[h] for h in hit)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Non-negative PU learning by full-batch Adam over chosen features."""
    if not positive:
        prior = min(max(prior, 0.01), 0.99)
        return Model(float(np.log(prior / (1 - prior))), {})
    ids, df = np.unique(np.concatenate(positive), return_counts=True)
    ids, df = ids[df >= min(MIN_POSITIVE, len(positive))], df[df >= min(MIN_POSITIVE, len(positive))]

    def columns(features: np.ndarray) -> np.ndarray:
        """Places among the chosen ids; one set at a time, as all at once would fill the driver's memory."""
        at = np.searchsorted(ids, features).astype(np.int32)
        return at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == features)] if len(ids) else at[:0]

    other = np.zeros(len(ids), np.int64)
    for features in unlabelled:
        other[columns(features)] += 1
    lift = (df / len(positive)) / ((other + 1) / (len(unlabelled) + 1 / max(prior, 1e-3)))
    worth = df * np.log(np.maximum(lift, 1e-9))
    keep = np.sort(np.argsort(-np.where(lift >= MIN_LIFT, worth, -np.inf), kind="stable")[: min(MAX_FEATURES, int((lift >= MIN_LIFT).sum()))])
    ids = ids[keep]

    def rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row and column numbers of the ones in the feature matrix."""
        found = [columns(s) for s in sets]
        return np.repeat(np.arange(len(sets)), [len(f) for f in found]), np.concatenate([*found, np.empty(0, np.int32)])

    (pr, pc), (ur, uc) = rows(positive), rows(unlabelled)
    weights, bias = np.zeros(len(ids)), float(np.log(max(prior, 1e-3) / (1 - min(prior, 0.999))))
    moments, t = [np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)], 0
    n_p, n_u = len(positive), max(1, len(unlabelled))
    for _ in range(EPOCHS):
        zp = bias + np.bincount(pr, weights[pc], n_p)
        zu = bias + np.bincount(ur, weights[uc], n_u)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if corrected >= 0 or not unlabelled:
            dp, du, sign = prior * ((sp - 1) - sp) / n_p, su / n_u, 1.0
        else:
            dp, du, sign = -prior * sp / n_p, su / n_u, -STEP_BACK
        grad = sign * np.append(np.bincount(pc, dp[pr], len(ids)) + np.bincount(uc, du[ur], len(ids)), dp.sum() + du.sum())
        grad[:-1] += DECAY * weights
        t += 1
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.999 * moments[1] + 0.001 * grad**2
        step = RATE * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-8)
        weights -= step[:-1]
        bias -= float(step[-1])
    return Model(bias, dict(zip(ids.tolist(), weights.tolist(), strict=True)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on a bounded sample of the rows that may be learnt from."""
    known = labels.select("doc_id", "toxic").where("toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    positives, n = known.agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.count("*")).first()
    prior = (positives or 0) / n if n else 0.0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(max_positive).select("doc_id", F.lit(True).alias("positive"))
    ids = docs.select("doc_id").where(~held_out(F.col("doc_id"))).where("doc_id is not null")
    others = ids.orderBy(*order).limit(max_unlabelled).select("doc_id", F.lit(False).alias("positive"))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen.unionByName(others)), "doc_id")  # max_positive + max_unlabelled rows
    sample = sample.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))  # an id counts once, however often it is repeated
    found = sample.mapInArrow(_sample_features, f"doc_id {dict(sample.dtypes)['doc_id']}, positive boolean, features binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("positive", "doc_id", "features")), strict=True)]
        sets = [(p, np.frombuffer(f, np.uint32)) for p, _, f in sorted(sets)]
        model = fit([f for p, f in sets if p], [f for p, f in sets if not p], prior)
        columns = [pa.array([model.bias]), pa.array([list(model.weights)], pa.list_(pa.int64())), pa.array([list(model.weights.values())], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["bias", "hashes", "weights"])

    made = found.repartition(1).mapInArrow(run, "bias double, hashes array<long>, weights array<double>").first()
    return Model(made.bias, dict(zip(made.hashes, made.weights, strict=True))) if made else fit([], [], prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.bias, model.weights))  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            scores = pa.array([own.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], scores], names=[*names, "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    names = ("doc_id", "held_out")
    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with all their columns, in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t) < 0.5 for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE_SQL: dict[str, str] = {}
