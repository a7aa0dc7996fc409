"""Splits and folds decided by a hash of the row's key.

``DataFrame.randomSplit`` depends on how rows happen to be partitioned. A hash of the
key gives every row the same side on any cluster, at any partitioning, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.functions.missing import quoted

STEPS = 1_000_000


def hash_number(key: Sequence[str], seed: int, modulus: int) -> Column:
    """A number in ``[0, modulus)`` from the first 32 bits of an MD5 over key and seed."""
    text = F.concat_ws("|", *[F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in key], F.lit(str(seed)))
    digits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(digits, F.lit(modulus))


def hash_split(
    df: DataFrame, key: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = 666
) -> list[DataFrame]:
    """Disjoint parts in about the given proportions that together are ``df``."""
    number = hash_number(key, seed, STEPS)
    bounds, reached = [0], 0.0
    for weight in weights:
        reached += weight
        bounds.append(round(STEPS * reached / sum(weights)))
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        # The outermost bounds always hold; without them most parts hash each row once.
        part = df if low == 0 else df.filter(number >= low)
        parts.append(part if high == STEPS else part.filter(number < high))
    return parts


def with_fold(df: DataFrame, key: Sequence[str], k: int = 3, seed: int = 667, name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1. Use another seed than the split's, or folds follow it."""
    return df.withColumn(name, hash_number(key, seed, k).cast("int"))
