"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.llm.common import checkpoint

#: Links that a task holds at once; if all are no more, one task finds the components.
AT_ONCE = 1 << 20


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of links(u, v), both long.

    By contraction: every node points at its smallest neighbour if that is smaller, pointers are followed
    twice as far once or more (in every round once more than in the one before), and links are then drawn
    between what their ends point at. Rounds go on until no link is left, so the result is whole; links
    never become more. Where nodes are hashes two or three rounds do, and a long chain in order takes
    some log(length). At the end the pointers of all rounds are followed from the last to the first.

    Minima are pre-aggregated, so a hub costs one row for each task; the joins read checkpoints, and
    adaptive execution may split them where a hub is hot. Only whether links are left reaches the driver.
    """
    edges = checkpoint(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pointers = checkpoint(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        for _ in range(1 + len(rounds)):
            further = pointers.select(F.col("u").alias("m"), F.col("m").alias("far"))
            pointers = checkpoint(pointers.join(further, "m").select("u", F.col("far").alias("m")))
        rounds.append(pointers)
        ends = edges.join(pointers, "u").select("v", F.col("m").alias("a"))
        ends = ends.join(pointers.withColumnRenamed("u", "v"), "v").where("a != m")
        edges = checkpoint(ends.select(F.greatest("a", "m").alias("u"), F.least("a", "m").alias("v")).distinct())
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = rounds.pop()
    while rounds:  # what a later round says of where an earlier one points
        later = found.select(F.col("u").alias("m"), F.col("m").alias("root"))
        found = checkpoint(rounds.pop().join(later, "m", "left").select("u", F.coalesce("root", "m").alias("m")))
    return found.select(F.col("u").alias("node"), F.col("m").alias("root"))


def least_reached(n: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For every one of n the smallest that it reaches by the links one[k], two[k]."""
    label, before = np.arange(n), None
    while before is None or (label != before).any():
        before, least = label, np.minimum(label[one], label[two])
        label = before.copy()
        for ends in (one, two):
            np.minimum.at(label, ends, least)
            np.minimum.at(label, before[ends], least)
        label = label[label]
    return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root of the components of links(u, v), of AT_ONCE or somewhat more at a time."""

    def found(held: list[np.ndarray]) -> pa.RecordBatch:
        nodes, ends = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        one, two = ends.reshape(2, -1)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[least_reached(len(nodes), one, two)])], names=["node", "root"])

    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("u", "v")]))
        if sum(x.shape[1] for x in held) >= AT_ONCE:
            yield found(held)
            held = []
    if held:
        yield found(held)


def gathered(links: DataFrame) -> DataFrame:
    """node, root as by components(), of links that lie in many small files.

    As many tasks as there are cores read them and pass on, of AT_ONCE at a time, only those of every node with the
    smallest one of its component. If these are no more than AT_ONCE in all, one task finds the components,
    and the driver is spared the rounds; of more, components() finds them.
    """
    tasks = links.sparkSession.sparkContext.defaultParallelism
    stars = checkpoint(links.where("u != v").select("u", "v").coalesce(tasks).mapInArrow(_stars, "node long, root long"))
    links = stars.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    if links.count() > AT_ONCE:
        return components(links)
    return checkpoint(links.coalesce(1).mapInArrow(_stars, "node long, root long"))
