"""Partitionings that depend on row contents alone.

Random work per partition (bagging, sampling) repeats only if every run sees the same
partitions in the same order. Hashing the whole row into a number of partitions that
follows from the row count gives that on any cluster and under any session's settings,
except that exact copies of one row meet in one partition. Groups of copies too large for
a task are cut into numbered slices first, which travel as one row with a count and
unfold on arrival.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.functions.missing import quoted

# A partition's rows: wanted, and at most (on average) once there are _MANY partitions.
ROWS_PER_PARTITION, ROWS_PER_TASK, _MANY = 25_000, 2_000_000, 512
_CHUNK = 4096


def partitions_of(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many partitions so many rows are dealt into, whatever the cluster."""
    wanted = min(_MANY, math.ceil(rows / ROWS_PER_PARTITION))
    return max(1, wanted, math.ceil(rows / rows_per_task))


def spread_rows(
    df: DataFrame, rows: int | None = None, partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The same rows, partitioned and sorted by content.

    ``rows`` is an upper bound of the row count, counted if not given. No slice of copies
    exceeds ``rows_per_task``; while all rows fit one task nothing is searched.
    """
    rows = df.count() if rows is None else rows
    partitions = partitions or partitions_of(rows, rows_per_task)
    columns = list(map(quoted, df.columns))
    if rows <= rows_per_task:
        return df.repartition(partitions, *columns).sortWithinPartitions(*columns)
    heavy = _heavy_slots(df, columns, rows, rows_per_task)
    if not heavy:  # each row is a slice of its own, in the place that the grouped form would give it
        alone = df.withColumn("_slice", F.lit(0).cast("long")).repartition(partitions, *columns, "_slice")
        return alone.select(*columns).sortWithinPartitions(*columns)
    counted = _sliced(df, columns, heavy, _slots(rows, rows_per_task), rows_per_task)
    placed = counted.repartition(partitions, *columns, "_slice")
    return _repeat(placed, F.col("_copies")).select(*columns).sortWithinPartitions(*columns)


def _slots(rows: int, slice_rows: int) -> int:
    return 1 << max(10, (16 * rows // slice_rows).bit_length())


def _slot(columns: list[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots))


def _heavy_slots(df: DataFrame, columns: list[str], rows: int, slice_rows: int) -> list[int]:
    """Slots of row hashes that hold more rows than a slice; a group of copies above the bound makes its slot one.

    At most rows / slice_rows numbers, so no more than tasks of the later shuffle.
    """
    loads = df.groupBy(_slot(columns, _slots(rows, slice_rows)).alias("_slot")).agg(F.count(F.lit(1)).alias("_load"))
    return [r["_slot"] for r in loads.filter(F.col("_load") > slice_rows).select("_slot").collect()]


def _sliced(df: DataFrame, columns: list[str], heavy: list[int], slots: int, slice_rows: int) -> DataFrame:
    """Rows with a slice number and a count of copies; only groups that may exceed a slice are grouped."""
    marked = df.withColumn("_slot", _slot(columns, slots))
    rare = marked.filter(~F.col("_slot").isin(heavy)).drop("_slot")
    groups = marked.filter(F.col("_slot").isin(heavy)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_all"))
    last = F.floor((F.col("_all") - 1) / slice_rows).cast("long")
    slices = groups.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        *columns,
        "_slice",
        F.least(F.lit(slice_rows), F.col("_all") - F.col("_slice") * slice_rows).alias("_copies"),
    )
    return rare.withColumns({"_slice": F.lit(0).cast("long"), "_copies": F.lit(1).cast("long")}).unionByName(slices)


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says, without an array of that length."""
    last_chunk = F.floor((times - 1) / _CHUNK).cast("long")
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    left = F.least(F.lit(_CHUNK), times - F.col("_chunk") * _CHUNK).cast("int")
    return chunks.withColumn("_repeat", F.explode(F.sequence(F.lit(1), left)))
