"""Image signatures: arrays of 64-bit words, compared by differing bits."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SIMILAR = 0.018


def distance(a: Column, b: Column, bits: int | None = None) -> Column:
    """Share of differing bits; 1 where lengths differ or there are none."""
    differing = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")), F.lit(0).cast("long"), lambda s, n: s + n)
    total = F.lit(bits) if bits else F.size(a) * 64
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), differing / total).otherwise(1.0)


def similar(a: Column, b: Column, threshold: float = SIMILAR, bits: int | None = None) -> Column:
    return a.isNotNull() & (distance(a, b, bits) <= threshold)


@F.pandas_udf(StringType())
def signature_hex(words: pd.Series) -> pd.Series:
    """Eight bytes of BLAKE2s over the packed bits, in hexadecimal (Spark has no BLAKE2)."""
    one = lambda w: None if w is None else hashlib.blake2s(np.asarray(w, dtype=">i8").tobytes(), digest_size=8).hexdigest()
    return words.map(one)
