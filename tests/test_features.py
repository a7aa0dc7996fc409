from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gablework.operators import features as ft


@pytest.fixture(scope="module")
def sample(spark):
    random = np.random.default_rng(11)
    n = 800
    a = random.normal(10, 3, n)
    frame = pd.DataFrame(
        {
            "a": a,
            "b": random.integers(0, 4, n).astype(float),
            "c": np.full(n, 2.0),
            "noise": random.uniform(size=n),
            "label": 3 * a + random.normal(size=n),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(4).cache()


COLUMNS = ["a", "b", "c", "noise"]


def transformed(df, stages, column):
    out = Pipeline(stages=[ft.assembler(COLUMNS), *stages]).fit(df).transform(df)
    return np.array([r[0] for r in out.select(vector_to_array(F.col(column))).collect()])


def test_standardized_features(sample):
    found = transformed(sample[1], [ft.standard_scaler()], ft.SCALED)
    assert found.mean(axis=0) == pytest.approx([0, 0, 0, 0], abs=1e-9)
    assert found.std(axis=0, ddof=1) == pytest.approx([1, 1, 0, 1])


def test_minmax_features(sample):
    found = transformed(sample[1], [ft.minmax_scaler()], ft.SCALED)
    assert found.min(axis=0) == pytest.approx([0, 0, 0.5, 0])
    assert found.max(axis=0) == pytest.approx([1, 1, 0.5, 1])


def test_assembling_nulls_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    with pytest.raises(Exception, match="null while assembling"):
        ft.assembler(["x", "y"]).transform(df).collect()


def test_exact_buckets_are_even_and_ties_collapse(spark):
    even = spark.range(1000).withColumn("x", F.col("id").cast("double"))
    counts = ft.fit_exact_buckets(even, "x", 20, "b").transform(even).groupBy("b").count().collect()
    assert len(counts) == 20 and all(49 <= r["count"] <= 51 for r in counts)
    zeros = even.withColumn("x", F.when(F.col("id") < 700, 0.0).otherwise(F.col("x")))
    model = ft.fit_exact_buckets(zeros, "x", 20, "b")
    assert len(model.getSplits()) < 21
    assert model.transform(zeros).count() == 1000


def test_chi_squared_agrees_with_the_contingency_table(sample):
    frame, df = sample
    coded = df.withColumn("half", (F.col("a") > 10).cast("double"))
    row = ft.chi_squared(coded, ["b"], "half", label_bins=0).first()
    table = pd.crosstab(frame["b"], frame["a"] > 10).to_numpy().astype(float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert row["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert row["degrees_of_freedom"] == 3


@pytest.mark.parametrize("selector", ["f", "chi"])
def test_selectors_keep_the_signal(sample, selector):
    stage = (
        ft.f_test_selector("label", 1)
        if selector == "f"
        else ft.ChiSquaredSelector(labelCol="label", numTopFeatures=1)
    )
    found = transformed(sample[1], [stage], ft.SELECTED)
    assert found.shape[1] == 1
    assert sorted(found[:, 0]) == pytest.approx(sorted(sample[0]["a"]))


def test_chi_squared_selector_works_on_raw_label_values(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 2), float(i % 3)) for i in range(60)], "u double, v double, y double")
    stages = [
        ft.assembler(["u", "v"]),
        ft.ChiSquaredSelector(labelCol="y", numTopFeatures=1, featureBins=0, labelBins=0),
    ]
    model = Pipeline(stages=stages).fit(df)
    assert model.stages[-1].getIndices() == [0]


def test_f_statistics(sample):
    frame, df = sample
    found = {r["feature"]: r["f_value"] for r in ft.f_statistics(df, ["a", "noise"], "label").collect()}
    for name, value in found.items():
        r = np.corrcoef(frame[name], frame["label"])[0, 1]
        assert value == pytest.approx(r * r / (1 - r * r) * (len(frame) - 2))


@pytest.mark.parametrize("scale_first", [False, True])
def test_components_are_orthonormal_and_ordered(sample, scale_first):
    frame, df = sample
    stages = [ft.assembler(["a", "b", "noise"]), *ft.pca_stages(3, scale_first)]
    model = Pipeline(stages=stages).fit(df).stages[-1]
    axes = model.pc.toArray()
    assert axes.T @ axes == pytest.approx(np.eye(3), abs=1e-9)
    explained = model.explainedVariance.toArray()
    assert list(explained) == sorted(explained, reverse=True)
    assert explained.sum() == pytest.approx(1)
    if not scale_first:
        assert explained[0] == pytest.approx(
            np.linalg.eigvalsh(np.cov(frame[["a", "b", "noise"]].T)).max() / frame[["a", "b", "noise"]].var().sum()
        )


def test_few_quantile_sketches_meet_in_the_task_that_merges_them(spark, monkeypatch):
    rows = spark.range(600).select(F.pmod("id", F.lit(37)).cast("double").alias("a"), (F.col("id") * 1.0).alias("b"), F.sqrt("id").alias("y"))
    partitions, fit = [], ft.QuantileDiscretizer.fit
    monkeypatch.setattr(ft.QuantileDiscretizer, "fit", lambda self, df: partitions.append(df.rdd.getNumPartitions()) or fit(self, df))
    many = ft.chi_squared(rows.repartition(90), ["a", "b"], "y", feature_bins=5).orderBy("feature_index").collect()
    assert max(partitions) <= 64
    assert [r["degrees_of_freedom"] for r in many] == [4 * 9, 4 * 9]
    assert many[0]["p_value"] > 0.01 > many[1]["p_value"]
