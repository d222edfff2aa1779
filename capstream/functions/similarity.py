"""Sequence similarity where Spark has no expression for it: Arrow batches of difflib ratios."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType

#: Pairs count as the same caption from these ratios on; short texts need the higher one.
LONG_RATIO, SHORT_RATIO, LONG_KEY = 0.88, 0.92, 8


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of `a` at once as bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    free = whole
    for c in b:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & whole
    return len(a) - free.bit_count()


def reaches(a: str, b: str, needed: float) -> bool:
    """SequenceMatcher(None, a, b).ratio() >= needed. Its blocks are a common subsequence: only where the longest is long enough is it asked."""
    return 2.0 * common_length(a, b) / (len(a) + len(b)) >= needed and SequenceMatcher(None, a, b).ratio() >= needed


@F.pandas_udf(BooleanType())
def alike(left: pd.Series, right: pd.Series, needed: pd.Series) -> pd.Series:
    """Whether the ratio in the order (previous, current) is high enough; null where either is."""
    return pd.Series([None if a is None or b is None else reaches(a, b, n) for a, b, n in zip(left, right, needed, strict=True)], dtype="object")


@F.pandas_udf(ArrayType(DoubleType()))
def mean_ratios(keys: pd.Series, members: pd.Series) -> pd.Series:
    """For each of `keys` the mean of its ratios with all members of the group, in order; different members are compared once."""

    def one(key: str, others: list[str]) -> float:
        if not key:
            return 0.0
        known = {o: SequenceMatcher(None, key, o).ratio() for o in dict.fromkeys(others)}
        return sum(known[o] for o in others) / len(others)

    found = [None if k is None or m is None else [one(x, list(m)) for x in k] for k, m in zip(keys, members, strict=True)]
    return pd.Series(found, dtype="object")


def same_key(previous: Column, current: Column) -> Column:
    """Decided without Python: equal keys, or one within the other; null previous is not the same."""
    some = (F.coalesce(previous, F.lit("")) != "") & (current != "")
    return some & ((previous == current) | F.contains(current, previous) | F.contains(previous, current))


def same_caption(previous: Column, current: Column) -> Column:
    """same_key, or a high enough ratio. Only pairs that lengths allow to reach it are sent to Python."""
    shorter, longer = F.least(F.length(previous), F.length(current)), F.greatest(F.length(previous), F.length(current))
    needed = F.when(shorter >= LONG_KEY, LONG_RATIO).otherwise(SHORT_RATIO)
    open_ = (shorter > 0) & ~same_key(previous, current) & (2 * shorter / (shorter + longer) >= needed)
    found = alike(F.when(open_, previous), F.when(open_, current), needed)
    return F.coalesce(same_key(previous, current), F.lit(False)) | F.coalesce(found, F.lit(False))
