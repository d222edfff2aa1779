"""What the corpus operators share: reading tables, cutting lineage, word patterns."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.session import share_package

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A key with over this share of all rows is joined by broadcast (heavy_keys).
HEAVY = 2000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below `sf_dir`, by a path that only Spark needs to open."""
    return share_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names.

    Only where a session on this machine alone (tests, a notebook) names none, a temporary folder is set;
    on a cluster that is an error, as executors would not see it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="capstream-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def heavy_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The keys of counts(key, n) that hold over 1 / HEAVY of all rows: fewer than HEAVY, however many rows there are."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) > total / HEAVY).select(key)


def with_known(rows: DataFrame, known: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """rows left joined with known(key, ...), a key of `heavy` (see heavy_keys) without bringing its rows together."""
    some = heavy.join(known.join(F.broadcast(heavy), key, "left_semi"), key, "left")
    hot = rows.join(F.broadcast(some), key)
    rest = rows.join(F.broadcast(some.select(key)), key, "left_anti").join(known, key, "left")
    return hot.unionByName(rest)


def unused(name: str, taken: Iterable[str]) -> str:
    """`name`, with more underscores before it while a column of any case is called so."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)
