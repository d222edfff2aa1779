"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has `lanes` words of 64 bits over the hashes of all word shingles of the whole text.
Its bits are grouped into parts, correlated bits together, and parts get thresholds of their own: if
the thresholds plus one sum to d + 1, then of two fingerprints that differ in at most d bits some part
differs in no more than its threshold. How selective a part is at each threshold is estimated on a
bounded sample of fingerprints (SAMPLE of the smallest hash), and dynamic programming deals the
thresholds out so that probes and candidates cost least. -1 leaves a part out. Any such choice
finds every link; the sample only decides the cost. Every fingerprint then probes the buckets of its parts,
and whoever meets is verified on all bits.

Scale: copies are folded into one class for each fingerprint before anything is compared. Of a
bucket's links only a spanning forest leaves its task. A bucket of over BUCKET_ROWS fingerprints goes
another, exact way if d is 2 at most: two fingerprints differ in at most 2 bits exactly if some
64-bit word differs from each in at most one, so every fingerprint is sent to the words around it
and points at the smallest one there, which is linear in the bucket and spreads over all tasks. With
larger d such a bucket is dealt into blocks, and every pair of blocks is compared in a task of its own.
Components come from links alone; classes learn their component, and documents their class's, where a
class of many documents is broadcast rather than brought together. Nothing but the sample reaches the driver.

Null text has no words, like an empty one: fingerprint zero. Null doc_id: the row is kept, and counts
only where no other id is in its component (component_id is then null). Repeated rows are one class.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import checkpoint, heavy_keys, table, with_known
from capstream.llm.graph import components

SHINGLE, DISTANCE, SEED = 3, 2, 42
SAMPLE, BUCKET_ROWS = 2048, 8192
#: Cost of writing and reading one probe, in verified candidates.
PROBE_COST = 60
_CHUNK = 1 << 15


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all word shingles, repeated ones too; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[shingle - 1 :], strict=False) if len(words) >= shingle else [(0, ends[-1])]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[s : e - 1], SEED) for s, e in spans), np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE, lanes: int = 1) -> bytes:
    """Big-endian bits, each 1 if it is set in over half of the shingles' hashes."""
    h = shingle_hashes(text, shingle)
    if not len(h):
        return bytes(8 * lanes)
    ones = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(h), _CHUNK):
        for lane in range(lanes):
            bits = np.unpackbits(_lane(h[at : at + _CHUNK], lane).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[64 * lane : 64 * lane + 64] += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(h)).tobytes()


def wide_fingerprint(h: np.ndarray, lanes: int) -> bytes:
    """The fingerprint of shingles' hashes, all lanes at once; bytes of words count the same bit of 255 hashes at a time."""
    ones = np.zeros((lanes, 8, 8), np.int64)  # by byte, then bit, from the lowest
    for at in range(0, len(h), 255):
        some = h[at : at + 255]
        x = some + (np.arange(lanes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
        x = _mixed(x)
        x[0] = some
        for bit in range(8):
            ones[:, :, bit] += ((x >> np.uint64(bit)) & np.uint64(0x0101010101010101)).sum(axis=1).astype("<u8").view(np.uint8).reshape(lanes, 8)
    return np.packbits(2 * ones.reshape(lanes, 64)[:, ::-1] > len(h)).tobytes()


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    """More hashes of the same shingles, by a mixing step for each lane after the first."""
    if not lane:
        return h
    return _mixed(h + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, carried: list[str], shingle: int = SHINGLE, lanes: int = 1) -> DataFrame:
    """The carried columns and fp of every document."""
    rows = docs.select(*carried, F.col("text").alias("_whole_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle, lanes) for t in batch.column("_whole_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(found, pa.binary())], names=[*carried, "fp"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in carried], "fp binary"]))


def bit_groups(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits (columns) in `parts` groups of about equal size, strongly correlated ones together."""
    x = bits.astype(np.float64) - bits.mean(axis=0) if len(bits) else bits.astype(np.float64)
    deviation = np.sqrt((x**2).sum(axis=0)) + 1e-12
    close = np.abs(x.T @ x) / np.outer(deviation, deviation)
    left, groups = list(range(bits.shape[1])), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [max(left, key=lambda b: (close[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            nearest = left[int(np.argmax(close[np.ix_(left, group)].sum(axis=1)))]
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t (from -1) for each part with sum(t + 1) = total and the least sum of costs[part][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t1, c in enumerate(part):
                if used + t1 <= total and (used + t1 not in new or cost + c < new[used + t1][0]):
                    new[used + t1] = (cost + c, [*chosen, t1 - 1])
        best = new
    return best[total]


def _part_costs(bits: np.ndarray, group: list[int], n: int, most: int) -> list[float]:
    """Estimated cost of a part at thresholds -1, 0 .. most, for n fingerprints."""
    own, w = bits[:, group].astype(np.float32), len(group)
    apart = own @ (1 - own).T
    apart = (apart + apart.T)[np.triu_indices(len(own), 1)]
    out, probes, ways = [0.0], 0, 1
    for t in range(most + 1):
        probes += ways
        ways = ways * (w - t) // (t + 1)
        share = max(float((apart <= t).mean()) if len(apart) else 0.0, probes / 2.0**w)
        out.append(n * probes * PROBE_COST + n * n * share / 2)
    return out


def make_plan(sample: list[bytes], n: int, bits: int, distance: int, parts: int | None = None) -> list[tuple[list[int], int]]:
    """(bits, threshold) for each part used."""
    ones = np.unpackbits(np.frombuffer(b"".join(sample), np.uint8).reshape(len(sample), bits // 8), axis=1)
    options = []
    for m in [parts] if parts else range(1, min(bits, distance + 3) + 1):
        groups = bit_groups(ones, m)
        total = m if parts else distance + 1
        most = 1 if parts else min(2, distance)
        cost, chosen = allocate([_part_costs(ones, g, n, most) for g in groups], total) if m * (most + 1) >= total else (np.inf, [])
        options.append((cost, m, [(g, t) for g, t in zip(groups, chosen, strict=False) if t >= 0]))
    return min(options, key=lambda o: o[:2])[2]


def _probes(classes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """part, key, home, node, fp: every fingerprint in its own buckets (home) and those it probes."""
    width = max(len(g) for g, _ in plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, fp = batch.column("node"), batch.column("fp")
            ones = np.unpackbits(np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(batch.num_rows, -1), axis=1)
            for part, (group, threshold) in enumerate(plan):
                keys = np.zeros((batch.num_rows, 8), np.uint8)
                packed = np.packbits(ones[:, group], axis=1)
                keys[:, : packed.shape[1]] = packed
                key = keys.view(">u8").ravel().astype(np.uint64)
                units = [np.uint64(1) << np.uint64(63 - i) for i in range(len(group))]
                flips = [np.uint64(0)]
                if threshold >= 1:
                    flips += units
                if threshold >= 2:
                    flips += [a ^ b for i, a in enumerate(units) for b in units[:i]]
                for flip in flips:
                    home = pa.array(np.full(batch.num_rows, flip == 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array((key ^ flip).view(np.int64)), home, node, fp],
                        names=["part", "key", "home", "node", "fp"],
                    )

    assert width <= 64
    return classes.select("node", "fp").mapInArrow(run, "part int, key long, home boolean, node long, fp binary")


def forest(words: np.ndarray, home: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of `words` (uint64, lanes wide), one of the two at home."""
    n = len(words)
    root = np.arange(n)
    edges = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    columns = np.ascontiguousarray(words.T)
    own = np.flatnonzero(home)
    step = max(1, 2_000_000 // max(1, n))
    for at in range(0, len(own), step):
        block = own[at : at + step]
        apart = np.zeros((len(block), n), np.uint16)
        for lane in columns:
            apart += np.bitwise_count(lane[block][:, None] ^ lane[None, :])
        i, j = np.nonzero(apart <= distance)
        i = block[i]
        ok = (i != j) & (root[i] != root[j])
        for a, b in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                edges.append((a, b))
        for a in range(n if edges and at + step < len(own) else 0):
            root[a] = find(a)
    return edges


def _verify(probes: DataFrame, distance: int, keys: list[str]) -> DataFrame:
    """u, v: a spanning forest of every bucket's links."""
    dealt = probes.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []

        def links() -> pa.RecordBatch | None:
            if len(rows) < 2:
                return None
            words = np.frombuffer(b"".join(r[2] for r in rows), ">u8").reshape(len(rows), -1).astype(np.uint64)
            found = forest(words, np.array([r[0] for r in rows]), distance)
            if not found:
                return None
            return pa.RecordBatch.from_arrays([pa.array([rows[e[k]][1] for e in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            for at, row in zip(
                zip(*(batch.column(k).to_pylist() for k in keys), strict=True), zip(*(batch.column(c).to_pylist() for c in ("home", "node", "fp")), strict=True), strict=True
            ):
                if at != bucket:
                    if (found := links()) is not None:
                        yield found
                    bucket, rows = at, []
                rows.append(row)
        if (found := links()) is not None:
            yield found

    return dealt.mapInArrow(run, "u long, v long")


def _around(nodes: DataFrame, distance: int) -> DataFrame:
    """Links of at most 2 bits between 64-bit fingerprints, which are their own node, by the words around each."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), b) for b in range(64)])
    around = nodes.select("node", F.explode(F.transform(flips, lambda f: F.col("node").bitwiseXOR(f))).alias("word"))
    if distance < 2:  # a word must then be a fingerprint itself
        found = around.join(nodes.select(F.col("node").alias("v")), F.col("word") == F.col("v")).select(F.col("node").alias("u"), "v")
        return found.where("u != v" if distance else "false")
    least = around.groupBy("word").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1")
    return around.join(least, "word").select(F.col("node").alias("u"), "v").where("u != v").distinct()


def near_links(classes: DataFrame, bits: int, distance: int, parts: int | None = None) -> DataFrame:
    """u, v: links whose components are those of all pairs of classes(node, fp) within the distance."""
    n = classes.count()
    sample = [bytes(r.fp) for r in classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    if not sample:
        return classes.select(F.col("node").alias("u"), F.col("node").alias("v"))
    probes = _probes(classes, make_plan(sample, n, bits, distance, parts))
    large = checkpoint(probes.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS))
    if large.isEmpty():
        return _verify(probes, distance, ["part", "key"])
    links = _verify(probes.join(large, ["part", "key"], "left_anti"), distance, ["part", "key"])
    hot = probes.join(large.select("part", "key", "n"), ["part", "key"])
    if distance <= 2 and bits == 64:
        return links.unionByName(_around(hot.select("node").distinct(), distance))
    # block against block: a member goes to every pair of blocks that its own is in, and each pair is a task's
    blocks = F.ceil(F.col("n") / BUCKET_ROWS).cast("long")
    hot = hot.withColumn("own", F.pmod(F.xxhash64("node", "part"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    hot = hot.select("part", "key", "home", "node", "fp", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    return links.unionByName(_verify(hot, distance, ["part", "key", "one", "two"]))


def grouped(docs: DataFrame, carried: list[str], shingle: int = SHINGLE, distance: int = DISTANCE, lanes: int = 1, parts: int | None = None, least: str | None = None) -> DataFrame:
    """The carried columns, fp and node, and the root of its component, of every document; with `least`, also that column's minimum there."""
    node = F.conv(F.hex("fp"), 16, -10).cast("long") if lanes == 1 else F.xxhash64("fp")
    prints = checkpoint(fingerprints(docs, carried, shingle, lanes).withColumn("node", node))
    classes = checkpoint(prints.groupBy("fp", "node").agg(F.count("*").alias("n"), *([F.min(least).alias("own")] if least else [])))
    found = components(near_links(classes, 64 * lanes, distance, parts))
    known = classes.drop("fp").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if least:  # minima of components, told to their classes; a component of many classes may be split by adaptive execution
        known = checkpoint(known)
        minima = checkpoint(known.groupBy("root").agg(F.min("own").alias("least")))
        known = known.join(minima, "root")
    return with_known(prints, known.drop("n", "own"), "node", heavy_keys(classes, "node"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grouped(table(spark, sf_dir, "documents"), ["doc_id"], least="doc_id")
    return rows.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.col("least").alias("component_id"))


QUERIES = {"op5_simhash": op5_simhash}
ORACLE_SQL: dict[str, str] = {}
