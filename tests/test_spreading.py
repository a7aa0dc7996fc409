from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gablework.functions import spreading
from gablework.functions.spreading import partitions_of, spread_rows


@pytest.fixture(scope="module")
def copies(spark):
    """6,000 rows: a third are copies of one row, another group is smaller, the rest differ."""
    hot = spark.range(2000).select(F.lit(1.5).alias("x"), F.lit("hot").alias("k"))
    warm = spark.range(150).select(F.lit(2.5).alias("x"), F.lit(None).cast("string").alias("k"))
    rest = spark.range(3850).select(F.rand(4).alias("x"), F.col("id").cast("string").alias("k"))
    return hot.unionByName(warm).unionByName(rest).cache()


def layout(df):
    """Row contents of every partition, in order."""
    parts: dict[int, list] = {}
    for r in df.withColumn("p", F.spark_partition_id()).collect():
        parts.setdefault(r["p"], []).append((r["x"], r["k"]))
    return parts


@pytest.mark.parametrize("rows_per_task", [100, 10_000])
def test_rows_are_kept_whole(copies, rows_per_task):
    out = spread_rows(copies, partitions=12, rows_per_task=rows_per_task)
    assert out.columns == copies.columns
    assert out.count() == 6000
    assert out.exceptAll(copies).count() == 0


def test_a_group_of_copies_is_split(copies):
    sizes = [len(rows) for rows in layout(spread_rows(copies, partitions=12, rows_per_task=100)).values()]
    assert max(sizes) < 1500
    unsplit = [len(rows) for rows in layout(spread_rows(copies, partitions=12, rows_per_task=10_000)).values()]
    assert max(unsplit) >= 2000


def test_layout_does_not_depend_on_the_input_partitioning(copies):
    layouts = [
        layout(spread_rows(frame, partitions=7, rows_per_task=100))
        for frame in (copies, copies.orderBy(F.rand(9)).repartition(13), copies.coalesce(1))
    ]
    assert layouts[0] == layouts[1] == layouts[2]


def test_a_loose_row_bound_is_enough(copies):
    exact = layout(spread_rows(copies, rows=6000, partitions=5, rows_per_task=500))
    loose = layout(spread_rows(copies, rows=9000, partitions=5, rows_per_task=500))
    assert exact == loose


def test_partitions_follow_from_the_row_count_alone():
    counts = [1, 25_000, 25_001, 10**7, 10**8, 10**9, 10**12]
    assert [partitions_of(n) for n in counts] == [1, 1, 2, 400, 512, 512, 500_000]
    assert all(n / partitions_of(n) <= 2_000_000 for n in counts)


def test_slices_stay_below_the_bound_whatever_the_table(spark):
    """A group of copies one five-thousandth of the rows is cut too."""
    rows = spark.range(50_000).select(F.when(F.col("id") < 60, -1).otherwise(F.col("id")).alias("x"))
    out = spread_rows(rows, partitions=40, rows_per_task=10)
    parts = out.filter("x = -1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 60 and len(parts) >= 4
    assert out.count() == 50_000


def test_without_heavy_groups_nothing_is_grouped(copies, monkeypatch):
    """Rows lie where the grouped form puts them, and copies are looked for in one pass."""
    few = copies.filter("k <> 'hot'")
    grouped = spreading._sliced(few, few.columns, [0, 1, 2], 1 << 10, 400).repartition(6, "x", "k", "_slice")
    expected = layout(spreading._repeat(grouped, F.col("_copies")).select("x", "k").sortWithinPartitions("x", "k"))
    monkeypatch.setattr(spreading, "_sliced", None)
    assert layout(spread_rows(few, rows=6000, partitions=6, rows_per_task=400)) == expected
