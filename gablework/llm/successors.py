"""Rows in key order beside the row that follows, without a one-task window.

Keys alone are dealt by range once to find cut points, the least key of each range. Rows then go to the
block between two cuts, in one shuffle of the texts; the first row of a block also goes, as a guest, to the
end of the block before, and that of the first block to the end of the last.

Defined cases: null keys sort first; equal keys are ordered by a hash of their text, and equal rows
follow one another; a lone row follows itself; null text counts as empty; an empty table has no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Blocks are hashed to tasks; several per task even out what each gets.
BLOCKS_PER_TASK = 4


def _place(key, tie) -> tuple:
    return (key is not None, key, tie)


def cut_points(docs: DataFrame, key: str, text: str) -> list[tuple]:
    """The least row of each key range, ascending; as many as there are blocks, whatever the rows."""
    blocks = BLOCKS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.coalesce(f"`{text}`", F.lit(""))).alias("tie"))
    ranges = keys.repartitionByRange(blocks, F.col("key").asc_nulls_first(), "tie").withColumn("part", F.spark_partition_id())
    rows = ranges.groupBy("part").agg(F.min(F.struct("key", "tie")).alias("least")).collect()
    return sorted(_place(r["least"]["key"], r["least"]["tie"]) for r in rows)


def in_key_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns ``block, guest, key, tie, text``: whole blocks per task, sorted; a guest ends each block."""
    cuts = cut_points(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    columns = ["block", "guest", "key", "tie", "text"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = {cut: number for number, cut in enumerate(cuts)}
        for batch in batches:
            places = [_place(k, t) for k, t in zip(batch.column("key").to_pylist(), batch.column("tie").to_pylist())]
            blocks = [bisect_right(cuts, place) - 1 for place in places]
            guests = [i for i, place in enumerate(places) if place in firsts]
            hosts = [(firsts[places[i]] - 1) % len(cuts) for i in guests]
            yield _tagged(batch, blocks, False)
            if guests:
                yield _tagged(batch.take(pa.array(guests)), hosts, True)

    def _tagged(batch: pa.RecordBatch, blocks: list[int], guest: bool) -> pa.RecordBatch:
        tags = [pa.array(blocks, pa.int32()), pa.array([guest] * len(blocks), pa.bool_())]
        return pa.RecordBatch.from_arrays([*tags, *[batch.column(c) for c in columns[2:]]], columns)

    whole = F.coalesce(f"`{text}`", F.lit(""))
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(whole).alias("tie"), whole.alias("text"))
    dealt = plain.mapInArrow(deal, f"block int, guest boolean, key {kind}, tie bigint, text string")
    order = ["block", "guest", F.col("key").asc_nulls_first(), "tie"]
    return dealt.repartition("block").sortWithinPartitions(*order)


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(key, text, next_text)`` of every row that is no guest, from a task's rows in order."""
    held = None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("block", "guest", "key", "text")]
        for block, guest, key, text in zip(*columns):
            if held is not None and held[0] == block:
                yield held[1], held[2], text
            held = None if guest else (block, key, text)
