"""Exact top-k inner-product search by ball trees, one per shard, with branch and bound.

Vectors are quantised to floor(256 * x). Candidates are dealt to the nearest of some pivots (clusters), and
clusters by hash into shards of bounded size; a ball tree is built for each shard. Queries travel in
blocks of one cluster, and a block carries its best hits and current k-th scores. It visits, in ROUNDS:
a shard of its own cluster, then the FEW clusters with the highest bounds, then all others. Only the queries whose
bound  q.pivot + |q| * radius  reaches their current k-th score go along to a cluster. In a shard the
tree is walked best first: nodes wait in a heap by the same bound, are opened only for queries that can
still gain, and leaves are scored exactly in integers. After every round a block's hits are merged
and its k-th scores rise.

Scale: shards hold at most about SHARD_ROWS vectors and blocks QUERY_ROWS queries, so a task holds one
tree and one block at a time whatever the sizes of the table and the query set. At most MAX_PIVOTS pivots with
their radii and sizes reach the driver and are sent to the tasks. A block keeps k hits for each query, so what a visit
returns is folded before the next. Copies of one vector share a cluster and spread over its shards.

Vectors that are null, or hold null, NaN or infinite components, take no part; neither do rows with
null vec_id, which could not be named in a result. Rows that repeat both id and vector count once;
an id with several vectors is searched, and found, with each, and never finds itself. Vectors of
different lengths are padded with zeros. Sums too large for a double to count exactly are computed in Python's integers,
and scores beyond a long become the nearest long. Ties go to the smaller vec_id. Fewer than k
candidates give fewer rows; an empty table none. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.llm.common import checkpoint, table

SCALE, K, QUERY_EVERY = 256, 5, 50
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 1024, 128
#: Clusters at most; clusters that a block sees in its second round.
MAX_PIVOTS, FEW, ROUNDS = 1024, 8, 3
LONG_MAX, LONG_MIN = 2**63 - 1, -(2**63)


class BallTree:
    """Centres and radii of nested groups of vectors; a leaf is a run of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order, nodes = np.arange(len(ids)), []

        def build(low: int, high: int) -> int:
            rows = vectors[order[low:high]]
            centre = rows.mean(axis=0)
            far = ((rows - centre) ** 2).sum(axis=1)
            me = len(nodes)
            nodes.append([centre, float(np.sqrt(far.max())) * (1 + 1e-9), low, high, -1, -1])
            if high - low > leaf_rows and far.max() > 0:
                one = rows[int(far.argmax())]
                other = rows[int(((rows - one) ** 2).sum(axis=1).argmax())]
                split = np.argsort(rows @ (other - one), kind="stable")
                order[low:high] = order[low:high][split]
                middle = (low + high) // 2
                nodes[me][4] = build(low, middle)
                nodes[me][5] = build(middle, high)
            return me

        if len(ids):
            build(0, len(ids))
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres = np.array([n[0] for n in nodes]).reshape(len(nodes), vectors.shape[1])
        self.radii = np.array([n[1] for n in nodes])
        self.spans = [tuple(n[2:]) for n in nodes]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray) -> list[tuple[int, int, float]]:
        """(query's place, vec_id, score) of all rows that may be among the k best; kth: scores to reach, and it rises."""
        if not self.spans or not len(query_ids):
            return []
        bounds = queries @ self.centres.T + np.linalg.norm(queries, axis=1)[:, None] * self.radii
        bounds += 1e-9 * np.abs(bounds) + 1e-3
        who, what, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        heap = [(-float(bounds[:, 0].max()), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            active = np.flatnonzero(bounds[:, node] >= kth)
            if not len(active):
                continue
            low, high, left, right = self.spans[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-float(bounds[active, child].max()), child))
                continue
            scores = queries[active] @ self.vectors[low:high].T
            found = (scores >= kth[active][:, None]) & (query_ids[active][:, None] != self.ids[low:high])
            q, c = np.nonzero(found)
            if not len(q):
                continue
            who, what, score = np.append(who, active[q]), np.append(what, self.ids[low:high][c]), np.append(score, scores[q, c])
            order = np.lexsort((what, -score, who))
            who, what, score = who[order], what[order], score[order]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            full = rank == k - 1
            kth[who[full]] = np.maximum(kth[who[full]], score[full])
            who, what, score = who[rank < k], what[rank < k], score[rank < k]
        return list(zip(who.tolist(), what.tolist(), score.tolist(), strict=True))


def _exact_search(tree_ids: list[int], tree: list[list[int]], query_ids: list[int], queries: list[list[int]], k: int) -> list[tuple[int, int, int]]:
    """The same in Python's integers, for components too large for doubles."""
    found = []
    for at, (i, q) in enumerate(zip(query_ids, queries, strict=True)):
        scores = ((-min(LONG_MAX, max(LONG_MIN, sum(x * y for x, y in zip(q, v, strict=True)))), j) for j, v in zip(tree_ids, tree, strict=True) if j != i)
        found += [(at, j, -s) for s, j in heapq.nsmallest(k, scores)]
    return found


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (doubles that are whole numbers) of the rows that take part, each pair once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    # beyond 2**52 every double is whole already, and floor() to a long would overflow
    whole = lambda y: F.when(F.abs(y) >= 2.0**52, y).otherwise(F.floor(y).cast("double"))
    v = F.transform("embedding", lambda x: whole(x.cast("double") * scale))
    rows = vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null").where(~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("copies")).drop("copies")


def _pack(lists: list[list[float]]) -> np.ndarray:
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width))
    for row, values in zip(out, lists, strict=True):
        row[: len(values)] = values
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


class Clusters:
    """Pivots, the radius around each that holds its rows, and into how many shards they go; bounded by MAX_PIVOTS."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.radii, self.shards, self.firsts = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)

    def fill(self, rows: dict[int, tuple[float, int]], shard_rows: int) -> None:
        for c, (radius, n) in rows.items():
            self.radii[c], self.shards[c] = radius, -(-n // shard_rows)
        self.firsts = np.cumsum(self.shards) - self.shards

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance to it."""
        vectors = _wide(vectors, self.pivots.shape[1])
        apart = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ self.pivots.T + (self.pivots**2).sum(axis=1)
        at = apart.argmin(axis=1)
        return at, np.sqrt(((vectors - self.pivots[at]) ** 2).sum(axis=1)) * (1 + 1e-9)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No row of a cluster scores higher with a query."""
        queries = _wide(queries, self.pivots.shape[1])
        high = queries @ self.pivots.T + np.linalg.norm(queries, axis=1)[:, None] * self.radii
        high += 1e-9 * (np.abs(high) + np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(self.pivots, axis=1)) + 1e-3
        high[:, self.shards == 0] = -np.inf
        return np.where(np.isinf(high), high, np.clip(high, LONG_MIN, LONG_MAX))


def _clusters(rows: DataFrame, shard_rows: int) -> tuple[Clusters, DataFrame]:
    """The clusters, and rows with their cluster."""
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    wanted = max(1, min(MAX_PIVOTS, -(-n // shard_rows)))
    pivots = _pack([r.v for r in rows.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(wanted).collect()])
    clusters = Clusters(_wide(pivots, max(1, width or 0)) if len(pivots) else np.zeros((1, 1)))
    sent = rows.sparkSession.sparkContext.broadcast(clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, far = sent.value.nearest(_pack(batch.column("v").to_pylist())) if batch.num_rows else (np.empty(0, np.int64), np.empty(0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(at, pa.int64()), pa.array(far)], names=["vec_id", "v", "cluster", "far"])

    dealt = checkpoint(rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, cluster long, far double"))
    sizes = dealt.groupBy("cluster").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()  # at most MAX_PIVOTS
    clusters.fill({r.cluster: (r.far, r.n) for r in sizes}, shard_rows)
    return clusters, dealt


def _build_trees(dealt: DataFrame, clusters: Clusters) -> DataFrame:
    def build(key, pdf):
        import pandas as pd

        tree = BallTree(pdf["vec_id"].to_numpy(), _pack(pdf["v"].tolist()))
        return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps(tree)]})

    shards, firsts = (F.array(*map(F.lit, a.tolist())) for a in (clusters.shards, clusters.firsts))
    at = (F.col("cluster") + 1).cast("int")
    shard = F.element_at(firsts, at) + F.pmod(F.xxhash64("vec_id", "v"), F.element_at(shards, at))
    return dealt.withColumn("shard", shard).groupBy("shard").applyInPandas(build, "shard long, tree binary")


class Block:
    """Some queries of one cluster, the best hits so far (query's place, vec_id, score), and the k-th scores."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, home: int):
        self.ids, self.vectors, self.home = ids, vectors, home
        self.kth = np.full(len(ids), -np.inf)
        self.hits = tuple(np.empty(0, np.int64) for _ in range(3))

    def merge(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> None:
        who, what, score = (np.concatenate([own, *(f[i] for f in found)]) for i, own in enumerate(self.hits))
        order = np.lexsort((what, -score, who)) if LONG_MIN not in score else np.lexsort((what, -(score.astype(object)), who))
        who, what, score = who[order], what[order], score[order]
        new = np.ones(len(who), bool)  # copies of a candidate count once
        new[1:] = (who[1:] != who[:-1]) | (what[1:] != what[:-1]) | (score[1:] != score[:-1])
        who, what, score = who[new], what[new], score[new]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        full = rank == k - 1
        self.kth[who[full]] = np.maximum(self.kth[who[full]], score[full])
        self.hits = who[rank < k], what[rank < k], score[rank < k]

    def visits(self, clusters: Clusters, number: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, places of the queries that go there) in a round."""
        bounds = clusters.bounds(self.vectors)
        first = int(clusters.firsts[self.home] + self.home % max(1, clusters.shards[self.home])) if clusters.shards[self.home] else -1
        if number == 0:
            if first >= 0:
                yield first, np.arange(len(self.ids))
            return
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        for c in (order[:FEW] if number == 1 else order[FEW:]).tolist():
            going = np.flatnonzero(bounds[:, c] >= self.kth)
            for shard in range(int(clusters.firsts[c]), int(clusters.firsts[c] + clusters.shards[c])) if len(going) else ():
                if shard != first:
                    yield shard, going


def _build_blocks(queries: DataFrame, query_rows: int) -> DataFrame:
    """block, data: queries(vec_id, v, cluster) in blocks of one cluster."""

    def build(key, pdf):
        import pandas as pd

        packed = Block(pdf["vec_id"].to_numpy(), _pack(pdf["v"].tolist()), int(key[0]))
        return pd.DataFrame({"data": [pickle.dumps(packed)]})

    sizes = queries.groupBy("cluster").agg(F.ceil(F.count("*") / query_rows).alias("parts"))
    dealt = queries.join(F.broadcast(sizes), "cluster").withColumn("part", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.col("parts")))  # at most MAX_PIVOTS sizes
    blocks = dealt.groupBy("cluster", "part").applyInPandas(build, "data binary")
    return checkpoint(blocks.select(F.xxhash64("data").alias("block"), "data"))


def _visits(blocks: DataFrame, clusters: Clusters, number: int) -> DataFrame:
    """shard, block, data (places, ids, vectors and k-th scores of the queries that go there)."""
    sent = blocks.sparkSession.sparkContext.broadcast(clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                own = pickle.loads(data)
                for shard, at in own.visits(sent.value, number):
                    out = pickle.dumps((at, own.ids[at], own.vectors[at], own.kth[at]))
                    yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([block]), pa.array([out], pa.binary())], names=["shard", "block", "data"])

    return blocks.mapInArrow(run, "shard long, block long, data binary")


def _search(trees: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """visits(shard, block, data) against trees(shard, tree): block, and the packed hits found there."""
    both = trees.select("shard", F.lit(False).alias("visit"), F.lit(0).cast("long").alias("block"), F.col("tree").alias("data"))
    both = both.unionByName(visits.select("shard", F.lit(True).alias("visit"), "block", "data"))
    both = both.repartition("shard").sortWithinPartitions("shard", "visit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, of = None, None
        for batch in batches:
            for shard, visit, block, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "visit", "block", "data")), strict=True):
                if not visit:
                    tree, of = pickle.loads(data), shard
                    continue
                at, ids, vectors, kth = pickle.loads(data)
                if of != shard:  # the hash left this shard empty
                    tree, of = BallTree(np.empty(0, np.int64), np.empty((0, vectors.shape[1]))), shard
                width = max(vectors.shape[1], tree.vectors.shape[1])
                most = [float(np.abs(a).max(initial=0)) for a in (vectors, tree.vectors)]
                if most[0] * most[1] * max(1, width) < 2.0**52 and max(most) < 2.0**40:
                    if width != tree.vectors.shape[1]:
                        tree.vectors, tree.centres = _wide(tree.vectors, width), _wide(tree.centres, width)
                    found = tree.search(ids, _wide(vectors, width), k, kth)
                else:
                    whole = [[[int(x) for x in row] for row in _wide(a, width)] for a in (tree.vectors, vectors)]
                    found = _exact_search(tree.ids.tolist(), whole[0], ids.tolist(), whole[1], k)
                who, what, score = zip(*found, strict=True) if found else ((), (), ())
                out = pickle.dumps((at[np.array(who, np.int64)], np.array(what, np.int64), np.array([int(s) for s in score], np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([out], pa.binary())], names=["block", "data"])

    return both.mapInArrow(run, "block long, data binary")


def _merged(blocks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The blocks with what a round has found; hits come one visit after another, k for each query at most."""
    both = blocks.select("block", F.lit(False).alias("hit"), "data").unionByName(found.select("block", F.lit(True).alias("hit"), "data"))
    both = both.repartition("block").sortWithinPartitions("block", "hit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([pickle.dumps(own)], pa.binary())], names=["block", "data"])

        for batch in batches:
            for block, hit, data in zip(*(batch.column(c).to_pylist() for c in ("block", "hit", "data")), strict=True):
                if hit:
                    own.merge([pickle.loads(data)], k)
                    continue
                if own is not None:
                    yield out()
                own, at = pickle.loads(data), block
        if own is not None:
            yield out()

    return both.mapInArrow(run, "block long, data binary")


def _rows(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                own = pickle.loads(data)
                who, what, score = own.hits
                yield pa.RecordBatch.from_arrays([pa.array(own.ids[who], pa.int64()), pa.array(what, pa.int64()), pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])

    return blocks.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: Column, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of candidates(vec_id, v) for each of those that `queries` picks."""
    clusters, dealt = _clusters(candidates, shard_rows)
    trees = checkpoint(_build_trees(dealt, clusters))
    blocks = _build_blocks(dealt.where(queries).select("vec_id", "v", "cluster"), query_rows)
    for number in range(ROUNDS):
        visits = checkpoint(_visits(blocks, clusters, number))
        if not visits.isEmpty():
            blocks = checkpoint(_merged(blocks, _search(trees, visits, k), k))
    # an id with several vectors has several queries
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = _rows(blocks).distinct().withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checkpoint(quantised(table(spark, sf_dir, "embeddings")))
    return top_k(rows, F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op1_topk": op1_topk}
ORACLE_SQL = {
    "op1_topk": """
    with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
               where vec_id is not null and embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint as score
          from v q join v c on q.vec_id != c.vec_id where q.vec_id % 50 = 0)
    select query_id, r::int as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from p) where r <= 5
    """
}
