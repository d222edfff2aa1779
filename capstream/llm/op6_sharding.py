"""Sharding by a hypergeometric communication matrix (native): a uniform shuffle with exact shard sizes.

Law `rows`: shard sizes are fixed beforehand, at most one row apart. Rows fall into hashed partitions;
how many rows of partition i go to shard j is drawn from the exact (multivariate hypergeometric)
law of a uniform permutation. Then every partition permutes its rows and deals them out by its row
of the matrix, the rows are exchanged, and every shard permutes what it got. Which rows meet does not
depend on tasks or machines, so a lost executor's part is rebuilt as it was.

Scale: the driver sees one count for each partition, at most MAX_PARTITIONS of them, and sends back
as many rows of the matrix. Permuting within a shard is done in two levels (hash stretches of about
STRETCH_ROWS rows), so no shard is ever sorted by one task.

Null text has no bytes; null doc_id is a row like any other. Repeated rows are numbered, so that they are dealt
independently. Where a row is repeated so often that its hashed partition stands out, its copies
(written once, with a number each) are spread over all partitions. Rows that tie in everything are equal, so
their order does not matter. An empty table gives an empty result. Columns not named are carried only if `keep`
names them; a kept column called shard or slot stays, and the operator's own is then called _shard or _slot.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capstream.llm.common import HEAVY, checkpoint, table, unused

SHARDS = 24
PARTITION_ROWS, MAX_PARTITIONS, STRETCH_ROWS = 16384, 65536, 8192


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows, drawn without return from good + bad, are good: exact for any size.

    Inversion around the mode; the weights of neighbouring counts are ratios, so no factorials and
    no limit on the number of rows (numpy's own sampler ends at 10**9).
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    mean_share = good / (good + bad)
    spread = int(12 * (draws * mean_share * (1 - mean_share)) ** 0.5) + 64
    up = np.arange(mode, min(high, mode + spread), dtype=np.float64)
    down = np.arange(mode, max(low, mode - spread), -1, dtype=np.float64)
    rise = np.cumprod((good - up) / (up + 1) * ((draws - up) / (bad - draws + up + 1)))
    fall = np.cumprod(down / (good - down + 1) * ((bad - draws + down) / (draws - down + 1)))
    weights = np.concatenate([fall[::-1], [1.0], rise])
    total = np.cumsum(weights)
    at = int(np.searchsorted(total, rng.random() * total[-1], side="right"))
    return mode - len(fall) + min(at, len(weights) - 1)


def communication_matrix(counts: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """Row i: how many of partition i's rows go to each shard. Rows sum to counts, columns to capacities."""
    rng = np.random.default_rng(seed)
    left, matrix = list(capacities), []
    for n in counts:
        rest, need, row = sum(left), n, []
        for j, room in enumerate(left):
            rest -= room
            got = hypergeometric(rng, room, rest, need) if need else 0
            row.append(got)
            left[j] -= got
            need -= got
        matrix.append(row)
    return matrix


def capacities(n: int, shards: int) -> list[int]:
    return [n // shards + (j < n % shards) for j in range(shards)]


def _spread(dealt: DataFrame, counted: dict[int, int], n: int, parts: int) -> DataFrame | None:
    """dealt(kept, draw, part) with the copies of rows that make a partition stand out in any partition; None where none does."""
    mean = n / parts
    high = [part for part, count in counted.items() if count > mean + 8 * mean**0.5 + PARTITION_ROWS / 8]
    if not high:
        return None
    draws = dealt.where(F.col("part").isin(high)).groupBy("draw").agg(F.count("*").alias("n"))
    draws = checkpoint(draws.where(F.col("n") > max(PARTITION_ROWS / 16, n / HEAVY)).select("draw"))  # fewer than HEAVY
    copies = dealt.join(F.broadcast(draws), "draw").withColumn("number", F.monotonically_increasing_id())
    copies = checkpoint(copies)  # so that a number stays what it is
    draw = F.xxhash64("draw", "number")
    copies = copies.select("kept", draw.alias("draw"), F.pmod(draw, F.lit(parts)).alias("part"))
    return dealt.join(F.broadcast(draws), "draw", "left_anti").select("kept", "draw", "part").unionByName(copies)


def shard_rows(rows: DataFrame, identity: list[Column], shards: int = SHARDS, seed: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` of `rows`, with shard and slot. `identity`: what tells rows apart."""
    spark = rows.sparkSession
    n = rows.count()
    parts = min(MAX_PARTITIONS, max(8, -(-n // PARTITION_ROWS)))
    dealt = rows.select(F.struct(*keep).alias("kept"), F.xxhash64(F.lit(seed), *identity).alias("draw"))
    dealt = dealt.withColumn("part", F.pmod("draw", F.lit(parts)))
    counted = dict(dealt.groupBy("part").count().collect())  # at most MAX_PARTITIONS rows
    spread = _spread(dealt, counted, n, parts)
    if spread is not None:
        dealt, counted = spread, dict(spread.groupBy("part").count().collect())
    counts = [counted.get(i, 0) for i in range(parts)]
    matrix = communication_matrix(counts, capacities(n, shards), seed)
    ends = [np.cumsum(row).tolist() for row in matrix]
    deal = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(ends)), "array<array<long>>")).alias("part", "ends"))
    kinds = dict(rows.dtypes)
    order = [F.col("draw"), *[F.col(f"kept.{c}") for c in keep if kinds[c] in ("bigint", "int")]]
    # repeated rows get numbers, so that they are dealt and placed independently
    numbered = dealt.repartition("part").withColumn("nth", F.row_number().over(Window.partitionBy("part", "draw").orderBy(*order)))
    dealt = numbered.withColumn("again", F.xxhash64(F.lit(seed + 1), "draw", "nth"))
    inside = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 2), "draw", "nth"), *order)
    dealt = dealt.withColumn("here", F.row_number().over(inside)).join(F.broadcast(deal), "part")
    dealt = dealt.withColumn("shard", F.expr("size(filter(ends, e -> e < here))"))
    bits = max(0, (max(1, n // (shards * STRETCH_ROWS)) - 1).bit_length())
    dealt = dealt.withColumn("stretch", F.shiftrightunsigned("again", 63 - bits).bitwiseAND((1 << bits) - 1))
    earlier = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("shard", "stretch").count()
    totals = totals.select("shard", "stretch", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("earlier"))
    here = Window.partitionBy("shard", "stretch").orderBy("again", *order)
    placed = dealt.withColumn("at", F.row_number().over(here) - 1).join(totals, ["shard", "stretch"])
    slot = (F.col("earlier") + F.col("at")).cast("long")
    return placed.select("kept.*", F.col("shard").alias(unused("shard", keep)), slot.alias(unused("slot", keep)))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = shard_rows(docs, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], keep=("doc_id", "size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op6_sharding": op6_sharding}
ORACLE_SQL: dict[str, str] = {}
