"""Bringing datasets together: a target column by key, and stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.functions.missing import quoted


class DuplicateKeys(ValueError):
    """A key that must be unique is repeated."""


def require_unique(frames: dict[str, DataFrame], key: str) -> None:
    """Raise if any frame repeats a key.

    Reads only the key column. Counts are combined before the shuffle, so a key that
    holds a large share of the rows costs one row per task.
    """
    tagged = None
    for name, frame in frames.items():
        keys = frame.select(F.col(quoted(key)).alias("key"), F.lit(name).alias("frame"))
        tagged = keys if tagged is None else tagged.unionByName(keys)
    repeated = tagged.groupBy("frame", "key").count().filter(F.col("count") > 1).take(1)
    if repeated:
        row = repeated[0]
        raise DuplicateKeys(f"{key} = {row['key']} occurs {row['count']} times in {row['frame']}")


def attach_target(features: DataFrame, target: DataFrame, key: str, keys_are_unique: bool = False) -> DataFrame:
    """Align two frames on a unique key, keeping keys that only one of them has.

    Repeated keys are an error: aligning on them has no meaning, and an outer join would
    multiply their rows in one task. ``keys_are_unique`` skips the check for keys that a
    source already guarantees.
    """
    if not keys_are_unique:
        require_unique({"features": features, "target": target}, key)
    return features.join(target, key, "full_outer")


def stack(frames: dict[str, DataFrame], origin: str = "source", rank: str = "source_rank") -> DataFrame:
    """Union by column name; columns a frame lacks are null.

    ``origin`` and ``rank`` record which frame a row came from and that frame's place, so
    that "first this file, then that one" remains a sort order.
    """
    stacked = None
    for place, (name, frame) in enumerate(frames.items()):
        part = frame.withColumns({origin: F.lit(name), rank: F.lit(place)})
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked
