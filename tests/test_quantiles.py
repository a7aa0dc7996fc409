from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gablework.functions.quantiles import KeyOrder, exact_quantiles
from gablework.operators.features import fit_exact_buckets
from gablework.operators.impute import fit_fills


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": np.asarray(values, dtype=float)})).repartition(5)


def expected(values, p, interpolate):
    ordered = np.sort(values)
    if interpolate:
        return float(np.quantile(ordered, p))
    return float(np.quantile(ordered, p, method="inverted_cdf"))


def shapes():
    random = np.random.default_rng(3)
    yield "uniform", random.uniform(-5, 5, 3000)
    yield "hot value", np.concatenate([np.zeros(2000), random.normal(size=1000)])
    yield "hot ends", np.concatenate([np.full(900, -1.0), random.normal(size=100) / 10, np.full(900, 1.0)])
    yield "two values", np.array([1.0] * 501 + [2.0] * 500)
    yield "constant", np.full(700, 4.5)
    yield "heavy tail", random.pareto(0.3, 2500)


@pytest.mark.parametrize("label,values", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("interpolate", [False, True])
def test_narrowing_is_exact(spark, label, values, interpolate):
    wanted = [0.0, 0.001, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(frame(spark, values), {"x": wanted}, interpolate, cells=16)["x"]
    assert found == pytest.approx([expected(values, p, interpolate) for p in wanted], rel=1e-12)


def test_missing_values_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert exact_quantiles(df, {"x": [0.5]}, interpolate=True)["x"] == [2.0]


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "x double, y int")
    assert exact_quantiles(df, {"x": [0.5, 0.9], "y": [0.5]}) == {"x": [None, None], "y": [1.0]}


def test_several_columns_at_once(spark):
    df = spark.range(1001).select(F.col("id").alias("a"), (-F.col("id")).alias("b"))
    found = exact_quantiles(df, {"a": [0.5], "b": [0.25]}, interpolate=True, cells=3)
    assert found == {"a": [500.0], "b": [-750.0]}


def test_infinite_values_have_ranks(spark):
    values = [float("-inf")] * 30 + [float(i) for i in range(100)] + [float("inf")] * 30
    found = exact_quantiles(frame(spark, values), {"x": [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]}, cells=4)["x"]
    assert found == [expected(values, p, False) for p in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)]


def test_whole_numbers_beyond_doubles_are_exact(spark):
    base = 2**60
    df = spark.range(1001).select((F.lit(base) + F.col("id") * 3 + 1).alias("x")).repartition(4)
    wanted = [0.0, 0.25, 0.5, 0.999, 1.0]
    assert exact_quantiles(df, {"x": wanted}, interpolate=True, cells=4)["x"][1:3] == [base + 751, base + 1501]
    found = exact_quantiles(df, {"x": wanted})["x"]
    assert found == [base + 3 * i + 1 for i in (0, 250, 500, 999, 1000)]
    buckets = fit_exact_buckets(df, "x", 4, "b")
    assert buckets.cuts == tuple(base + 3 * i + 1 for i in (250, 500, 750))
    assert [r["count"] for r in buckets.transform(df).groupBy("b").count().orderBy("b").collect()] == [250, 250, 250, 251]


def test_decimals_of_full_width_are_exact(spark):
    digits = [10**37 + 7 * i for i in range(301)]
    rows = [(Decimal(f"{d}E-5"),) for d in digits] + [(None,)]
    df = spark.createDataFrame(rows, "x decimal(38,5)").repartition(3)
    found = exact_quantiles(df, {"x": [0.5, 0.1]}, cells=7)["x"]
    assert found == [Decimal(f"{digits[150]}E-5"), Decimal(f"{digits[30]}E-5")]
    even = exact_quantiles(df.filter(F.col("x") > F.lit(str(rows[0][0])).cast("decimal(38,5)")), {"x": [0.5]}, interpolate=True)["x"]
    assert even == [Decimal(f"{(digits[150] + digits[151]) * 5}E-6")]


def test_many_columns_of_many_types_under_one_table(spark):
    types = ["double", "float", "bigint", "int", "smallint", "decimal(12,2)", "boolean"]
    columns = [(F.hash("id", F.lit(i)) % (5 + i)).alias(f"c{i}") for i in range(300)]
    raw = spark.range(400).select(*columns).repartition(3)
    df = raw.select(*[F.col(f"c{i}").cast(types[i % 7]).alias(f"c{i}") for i in range(300)])
    found = exact_quantiles(df, {c: [0.5] for c in df.columns})
    local = df.toPandas()
    for name in df.columns:
        ordered = sorted(local[name])
        assert found[name] == [ordered[199]], name


def test_keys_keep_the_order_of_doubles(spark):
    order = KeyOrder.of(spark.range(1).select(F.lit(1.0).alias("x")).schema["x"].dataType)
    values = [float("-inf"), -1e308, -1.5, -5e-324, 0.0, 5e-324, 1e-300, 1.5, 1e308, float("inf")]
    keys = [order.key(v) for v in values]
    assert keys == sorted(keys) and [order.value(k) for k in keys] == values and order.key(-0.0) == 0


def test_fills_keep_large_whole_numbers(spark):
    base = 2**60 + 1
    df = spark.createDataFrame([(1, base), (2, base + 2), (3, base + 4), (4, None)], "id int, x bigint")
    for fills in (fit_fills(df, median=["x"], keep_types=True), fit_fills(df, mean=["x"], keep_types=True)):
        assert [r.x for r in fills.apply(df).orderBy("id").collect()] == [base, base + 2, base + 4, base + 2]
    assert fit_fills(df, mean=["x"]).apply(df).dtypes == [("id", "int"), ("x", "double")]
