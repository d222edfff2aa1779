"""Confidence, quality and ranks of recognised text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstream.functions.text import meaningful_length, once


def weight(text: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), meaningful_length(text))


def weighted_confidence(lines: Column) -> Column:
    """Of an array of struct(text, confidence): mean weighted by meaningful length; 0 for none."""
    zero = F.struct(F.lit(0.0).alias("top"), F.lit(0).cast("long").alias("all"))
    add = lambda a, x: once(weight(x["text"]), lambda w: F.struct((a["top"] + x["confidence"] * w).alias("top"), (a["all"] + w).alias("all")))
    return F.aggregate(lines, zero, add, lambda a: F.when(a["all"] > 0, a["top"] / a["all"]).otherwise(0.0))


def quality(text: Column, confidence: Column, n_lines: Column) -> Column:
    """0 to 1 from confidence, length and lines; very short texts lose some."""
    return _with_length(text, lambda n: quality_of(n, confidence, n_lines))


def quality_of(n: Column, confidence: Column, n_lines: Column) -> Column:
    """quality of a text of n meaningful characters; n is used several times."""
    score = confidence * 0.72 + F.least(F.lit(1.0), F.log2(n + 1.0) / 4.0) * 0.23 + F.least(F.lit(1.0), n_lines / 2.0) * 0.05
    score = score - F.when(n == 1, 0.22).when(n == 2, 0.06).otherwise(0.0)
    return F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def _with_length(text: Column, of: Callable[[Column], Column]) -> Column:
    """`of` the meaningful length, which is measured once however often it is used."""
    return once(meaningful_length(text), of)


def candidate_rank(text: Column, confidence: Column, q: Column) -> Column:
    """Larger is better."""
    n = meaningful_length(text)
    return F.struct((q + F.least(n, F.lit(12)) * 0.008).alias("rank"), n.alias("length"), confidence.alias("confidence"))


def needs_enhancement(text: Column, confidence: Column, q: Column, threshold: float = 0.78, n: Column | None = None) -> Column:
    """n: the meaningful length, where it is known."""
    return (text == "") | ((meaningful_length(text) if n is None else n) < 4) | (confidence < threshold) | (q < 0.68)


def needs_binary_pass(text: Column, confidence: Column, q: Column, n: Column | None = None) -> Column:
    return (text == "") | ((meaningful_length(text) if n is None else n) <= 1) | (confidence < 0.58) | (q < 0.50)


def sample_rank(text: Column, confidence: Column, q: Column) -> Column:
    return F.struct((q * 0.65 + confidence * 0.35).alias("support"), meaningful_length(text).alias("length"), confidence.alias("confidence"))


def is_fragment(text: Column, confidence: Column) -> Column:
    """Nothing meaningful, or one character without confidence."""
    return _with_length(text, lambda n: (n == 0) | ((n == 1) & (confidence < 0.72)))
