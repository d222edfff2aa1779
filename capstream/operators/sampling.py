"""Which frames to look at, and which recognitions to use again."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def throttle(times: Column, interval: float) -> Column:
    """Of sorted times the first, and each that is at least `interval` after the last one kept."""

    def add(kept: Column, t: Column) -> Column:
        return F.when((F.size(kept) == 0) | (t - F.try_element_at(kept, F.lit(-1)) >= interval), F.concat(kept, F.array(t))).otherwise(kept)

    return F.aggregate(times, F.array().cast("array<double>"), add)


def throttled(events: DataFrame, key: str, time: str, interval: float, start: float | None = None, end: float | None = None) -> DataFrame:
    """key, number, time: the greedy sample of every key's times, within start and end if given."""
    rows = events.select(key, F.col(time).cast("double").alias("time")).where("time is not null")
    if start is not None:
        rows = rows.where(F.col("time") >= start)
    if end is not None:
        rows = rows.where(F.col("time") <= end)
    kept = rows.groupBy(key).agg(throttle(F.array_sort(F.collect_list("time")), interval).alias("kept"))
    return kept.select(key, F.posexplode("kept").alias("number", "time"))


def nominal_time(key: str, order: str, interval: float, start: float = 0.0) -> Column:
    """The time a frame stands for: its number, not its clock."""
    return F.lit(start) + (F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1) * interval


def reuse(frames: DataFrame, key: str, order: str, words: str, threshold: float, bits: int | None = None) -> DataFrame:
    """key, order, action (call, exact, near), source: the frame whose recognition each frame uses.

    An exact repeat of any recognised frame of the key is reused; else one near enough to the frame
    just before, whose signature then counts as the last one although it is not remembered.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        known: dict[bytes, object] = {}
        last, last_source, out = None, None, []
        for at, value in zip(pdf[order], pdf[words], strict=True):
            own = np.asarray(value, np.int64)
            code = own.tobytes()
            if code in known:
                action, source = "exact", known[code]
            elif last is not None and len(own) and len(own) == len(last) and int(np.bitwise_count((own ^ last).view(np.uint64)).sum()) / (bits or 64 * len(own)) <= threshold:
                action, source = "near", last_source
            else:
                action, source = "call", at
                known[code] = at
            last, last_source = own, source
            out.append((pdf[key].iloc[0], at, action, source))
        return pd.DataFrame(out, columns=[key, order, "action", "source"])

    kinds = dict(frames.dtypes)
    return frames.select(key, order, words).groupBy(key).applyInPandas(fold, f"{key} {kinds[key]}, {order} {kinds[order]}, action string, source {kinds[order]}")


def reuse_counts(reused: DataFrame, key: str) -> DataFrame:
    """key, frames, calls, exact, near of what reuse() decided."""
    kinds = [F.count_if(F.col("action") == a).alias(name) for a, name in (("call", "calls"), ("exact", "exact"), ("near", "near"))]
    return reused.groupBy(key).agg(F.count("*").alias("frames"), *kinds)


def exact_reuse(frames: DataFrame, key: str, order: str, signature: str, into: str = "used") -> DataFrame:
    """frames with `into`: the first frame of the key with the same signature, found natively before any recognition."""
    return frames.withColumn(into, F.first(order).over(Window.partitionBy(key, signature).orderBy(order)))
