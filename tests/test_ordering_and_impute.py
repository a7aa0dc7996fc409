from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gablework.functions.ordering import number_rows, range_blocks
from gablework.operators.impute import StatisticFills, fill_along, fill_literal, fill_zero, fit_fills


def plain_window(df, columns, order_by, forward=True):
    """The one-task form that the block form must agree with."""
    keys = [F.col(c).asc_nulls_first() for c in order_by]
    if forward:
        window = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
    window = Window.orderBy(*keys).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.first(c, ignorenulls=True).over(window) for c in columns})


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def gaps(spark):
    """1,000 rows, one source holding two thirds of them, long runs of nulls, a sparse skewed id."""
    random = np.random.default_rng(5)
    n = 1000
    frame = pd.DataFrame(
        {
            "source_rank": np.where(np.arange(n) < 667, 0, 1),
            "id": np.cumsum(random.pareto(0.5, n).clip(0, 1e7).astype("int64") + 1),
            "name": [f"https://example.org/item/{i:05d}" for i in random.permutation(n)],
            "day": pd.to_datetime("2020-01-01") + pd.to_timedelta(random.permutation(n), unit="h"),
            "score": random.permutation(n) / 7,
        }
    )
    text = np.where(random.uniform(size=n) < 0.04, [f"t{i}" for i in range(n)], None)
    number = np.where(random.uniform(size=n) < 0.02, np.arange(n, dtype=float), np.nan)
    frame["text"] = text
    frame["number"] = number
    df = spark.createDataFrame(frame)
    return df.withColumn("number", F.nanvl("number", F.lit(None))).repartition(7)


@pytest.mark.parametrize("order_by", [["id"], ["source_rank", "id"], ["name"], ["day"], ["score"], ["day", "id"]])
@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_block_fill_equals_plain_window(gaps, order_by, direction):
    found = fill_along(gaps, ["text", "number"], order_by, direction)
    assert same_rows(found, plain_window(gaps, ["text", "number"], order_by, direction == "forward"))


@pytest.mark.parametrize("order_by", [["id"], ["source_rank", "id"], ["name"], ["day"]])
def test_blocks_are_even_whatever_the_key(gaps, order_by):
    sizes = range_blocks(gaps, order_by, "block", 10).groupBy("block").count().collect()
    assert len(sizes) == 10
    assert max(r["count"] for r in sizes) < 200


def test_leading_nulls_stay_null(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, None)], "id int, v string")
    rows = fill_along(df, ["v"], ["id"]).orderBy("id").collect()
    assert [r["v"] for r in rows] == [None, None, "a", "a"]


def test_null_order_keys_come_first(spark):
    df = spark.createDataFrame([(None, "z"), (5, None), (6, "b"), (7, None)], "id int, v string")
    rows = fill_along(df, ["v"], ["id"]).collect()
    assert {r["id"]: r["v"] for r in rows} == {None: "z", 5: "z", 6: "b", 7: "b"}


def test_wide_keys_do_not_overflow(spark):
    df = spark.createDataFrame([(-(2**62), 1), (2**62, 2), (0, 3)], "a long, b long")
    assert [r["n"] for r in number_rows(df, ["a", "b"], "n").orderBy("a").collect()] == [1, 2, 3]


def test_row_numbers_match_plain_window(gaps):
    found = number_rows(gaps, ["source_rank", "id"], "n")
    plain = gaps.withColumn("n", F.row_number().over(Window.orderBy("source_rank", "id")))
    assert same_rows(found.select("id", "n"), plain.select("id", "n"))


def test_fill_is_planned_with_one_shuffle_of_the_rows(spark, tables):
    from gablework.sources.tables import table

    orders = table(spark, tables, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = fill_along(orders, ["s"], ["o_orderkey"])
        plan = filled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Rows by block, block ends by block, ends to one task (one row each), carried values by block.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Exchange SinglePartition") == 1


def test_ranges_cut_ties_long_prefixes_and_null_keys(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 4 > 0, (F.col("id") % 2).cast("double")).alias("tied"),
        F.concat(F.lit("https://a-long-common-start.example/"), F.format_string("%06d", "id")).alias("url"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"),
        "id",
    )
    for keys in (["tied", "url"], ["url"], ["at"]):
        ranges = range_blocks(rows, keys, "r", 8)
        sizes = [r["count"] for r in ranges.groupBy("r").count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / 8
    numbered = number_rows(rows, ["tied", "url"], "n").toPandas()
    expected = numbered.sort_values(["tied", "url"], na_position="first")
    assert expected["n"].tolist() == list(range(1, 4001))


def test_long_ranges_fill_backward_in_linear_time(spark):
    rows = spark.range(400_000).select("id", F.when(F.col("id") % 100_000 == 99_999, F.col("id")).alias("v"))
    found = fill_along(rows.coalesce(1), ["v"], ["id"], direction="backward")
    # Quadratic work would take hours.
    assert found.filter(F.col("v") != (F.floor(F.col("id") / 100_000) + 1) * 100_000 - 1).count() == 0


def test_fill_zero_and_literal_cover_their_types_only(spark):
    df = spark.createDataFrame([(None, None, float("nan")), (1, "a", 2.0)], "i int, s string, d double")
    zeroed = fill_zero(df, ["i", "d"])
    assert zeroed.collect()[0].asDict() == {"i": 0, "s": None, "d": 0.0}
    assert fill_literal(zeroed).collect()[0]["s"] == "None"


def test_mean_and_median_are_learned_apart_from_their_use(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 5.0), (None, 3.0), (9, None)], "i int, d double")
    fills = fit_fills(train, mean=["i"], median=["d"])
    assert fills.values == {"i": 4.0, "d": 3.0}
    other = spark.createDataFrame([(None, None), (7, 8.0)], "i int, d double")
    assert [tuple(r) for r in fills.apply(other).collect()] == [(4.0, 3.0), (7.0, 8.0)]


def test_column_without_values_is_left_alone(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "a double, b double")
    fills = fit_fills(df, mean=["a"], median=["b"])
    assert fills == StatisticFills({"a": None, "b": None})
    assert [tuple(r) for r in fills.apply(df).collect()] == [(None, None), (None, None)]
