"""Order-preserving blocks, so that row-order operators need no one-task window.

A window without a partition key runs in a single task. Here rows are cut into
contiguous blocks of about equal depth along the sort order. Work inside a block is a
partitioned window; what crosses block borders is one small row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.functions.missing import quoted
from gablework.sources.scratch import materialize


def range_blocks(df: DataFrame, order_by: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """The rows, written out with the number of the key range they fall into.

    Ranges are cut over all of ``order_by`` (nulls first), so ties in a leading key, texts with a
    long common start and composite keys are all split, and any orderable type will do. Numbers
    ascend with the keys. Without ``partitions`` the session's shuffle partitions are
    cut, and adaptive execution joins small neighbours. Written, because ranges are
    sampled anew for each execution.
    """
    keys = [F.col(quoted(c)).asc_nulls_first() for c in order_by]
    dealt = df.repartitionByRange(*keys) if partitions is None else df.repartitionByRange(partitions, *keys)
    return materialize(dealt.withColumn(name, F.spark_partition_id()), "ranges")


def number_rows(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """1-based row number along ``order_by`` without a one-task sort of the rows."""
    block = name + "_block"
    labelled = range_blocks(df, order_by, block)
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        labelled.groupBy(block)
        .agg(F.count(F.lit(1)).alias("block_rows"))
        .select(block, F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("block_offset"))
    )
    within = Window.partitionBy(block).orderBy(*[F.col(quoted(c)).asc_nulls_first() for c in order_by])
    return (
        labelled.withColumn(name, F.row_number().over(within))
        .join(offsets, block)
        .withColumn(name, F.col(name) + F.col("block_offset"))
        .drop(block, "block_offset")
    )
