"""Captions as they arrive: sessions of samples, throttled sampling with state, appended segments."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.session import share_package, shared_folder


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Events of a folder of Parquet files, as a stream with a real timestamp."""
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """key, start, end, n of stretches without a longer pause; late events are dropped after the watermark."""
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n"))
    return rows.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def throttled(events: DataFrame, key: str, interval: float) -> DataFrame:
    """key, time: the greedy sample of operators.sampling.throttle, kept up from batch to batch with one number of state for each key.

    Within a batch times are sorted; a time before the last one kept is too late to change anything.
    """
    share_package(events.sparkSession)
    kinds = dict(events.dtypes)

    def step(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        kept = []
        for t in sorted(t for batch in batches for t in batch["time"].tolist()):
            if last is None or t - last >= interval:
                kept.append(t)
                last = t
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({key: [group[0]] * len(kept), "time": kept})

    timed = events.select(key, (F.unix_micros("ts") / 1e6).alias("time"))
    return timed.groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, time double", "last double", "append", "NoTimeout")


def drained(stream: DataFrame, mode: str = "append", path: str | None = None) -> DataFrame:
    """All that a stream yields from what is there now, by way of Parquet files in `path` or the shared folder.

    With mode complete every batch replaces what the one before wrote; append writes each row once.
    """
    spark = stream.sparkSession
    home = path or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema

    def whole(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/rows")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/state").trigger(availableNow=True)
    writer = writer.foreachBatch(whole) if mode == "complete" else writer.format("parquet").option("path", f"{home}/rows")
    writer.start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{home}/rows")


def append_segments(stream: DataFrame, path: str, checkpoint: str, key: str = "output_key", buckets: int = 64):
    """Start appending segments to Parquet, each batch once, in folders of hashed keys, so that their number is bounded."""
    rows = stream.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("bucket").start(path)
