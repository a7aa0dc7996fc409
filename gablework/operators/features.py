"""Feature stages for Spark ML pipelines, and the same steps as plain functions.

The stages are Spark's own. Two things are added: exact cut points for bucketing, and a
chi-squared selector that accepts continuous columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import (
    PCA,
    MinMaxScaler,
    QuantileDiscretizer,
    StandardScaler,
    UnivariateFeatureSelector,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.stat import ChiSquareTest
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.functions.missing import quoted
from gablework.functions.quantiles import KeyOrder, exact_quantiles

FEATURES = "features"
SCALED = "normalized_features"
SELECTED = "selected_features"
PROJECTED = "pca_features"

# One task merges all partitions' quantile sketches of a test, so they are no more than this.
_SKETCHES = 64


def assembler(columns: Sequence[str], output: str = FEATURES) -> VectorAssembler:
    """Nulls are an error, so impute or run the completeness gate first."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def standard_scaler(source: str = FEATURES, output: str = SCALED) -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def minmax_scaler(source: str = FEATURES, output: str = SCALED) -> MinMaxScaler:
    return MinMaxScaler(inputCol=source, outputCol=output)


def quantile_discretizer(column: str, buckets: int = 20, output: str | None = None) -> QuantileDiscretizer:
    """Approximate cut points (rank error 0.001), fitted inside a pipeline."""
    return QuantileDiscretizer(
        numBuckets=buckets, inputCol=column, outputCol=output or f"{column}_discretized", relativeError=0.001
    )


@dataclass(frozen=True)
class ExactBuckets:
    """Bucket numbers by comparison with exact cut points, in the column's own type.

    A bucket holds its lower end. Missing values go to a last bucket of their own.
    """

    column: str
    cuts: tuple
    output: str

    def getSplits(self) -> list:
        return [-math.inf, *self.cuts, math.inf]

    def transform(self, df: DataFrame) -> DataFrame:
        order, value = KeyOrder.of(df.schema[self.column].dataType), "_bucketed"
        while value in df.columns:
            value = "_" + value
        last = float(len(self.cuts) + 1)
        valued = df.withColumn(value, order.of_column(df, self.column))
        bucket = F.expr(f"if({value} IS NULL, {last!r}D, double({order.cell(value, self.cuts)}))")
        return valued.withColumn(self.output, bucket).drop(value)


def fit_exact_buckets(df: DataFrame, column: str, buckets: int = 20, output: str | None = None) -> ExactBuckets:
    """Exact cut points at any size. Equal ones collapse, so heavy ties give fewer buckets."""
    shares = [i / buckets for i in range(1, buckets)]
    cuts = {c for c in exact_quantiles(df, {column: shares})[column] if c is not None}
    if not cuts:
        raise ValueError(f"{column} has no values to bucket")
    return ExactBuckets(column, tuple(sorted(cuts)), output or f"{column}_discretized")


def pca_stages(k: int = 9, scale_first: bool = False, source: str = FEATURES, output: str = PROJECTED) -> list:
    """Principal components of the raw features, or of standardized ones."""
    if not scale_first:
        return [PCA(k=k, inputCol=source, outputCol=output)]
    return [standard_scaler(source), PCA(k=k, inputCol=SCALED, outputCol=output)]


def f_test_selector(label: str, top: int = 16, output: str = SELECTED) -> UnivariateFeatureSelector:
    """Top features by F-test: continuous features against a continuous label."""
    selector = UnivariateFeatureSelector(
        featuresCol=FEATURES, labelCol=label, outputCol=output, selectionMode="numTopFeatures"
    )
    return selector.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(top)


class ChiSquaredSelector(
    Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Top features by a chi-squared test of independence from the label.

    The test needs categories, so features and label are cut into quantile bins for the
    test alone; the fitted stage slices the original vector. With ``labelBins = 0`` each
    label value is its own category, which Spark accepts up to 10,000 of them, and with
    ``featureBins = 0`` the same holds for the features.
    """

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "features to keep", TypeConverters.toInt)
    featureBins = Param(Params._dummy(), "featureBins", "bins per feature, 0 for none", TypeConverters.toInt)
    labelBins = Param(Params._dummy(), "labelBins", "bins of the label, 0 for none", TypeConverters.toInt)

    def __init__(
        self,
        featuresCol: str = FEATURES,
        labelCol: str = "label",
        outputCol: str = SELECTED,
        numTopFeatures: int = 16,
        featureBins: int = 20,
        labelBins: int = 10,
    ) -> None:
        super().__init__()
        self._set(
            featuresCol=featuresCol,
            labelCol=labelCol,
            outputCol=outputCol,
            numTopFeatures=numTopFeatures,
            featureBins=featureBins,
            labelBins=labelBins,
        )

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        source, label = self.getFeaturesCol(), self.getLabelCol()
        width = len(dataset.select(source).first()[0])
        spread = dataset.select(
            F.col(quoted(label)).cast("double").alias("label"),
            *[vector_to_array(F.col(quoted(source)))[i].alias(f"f{i}") for i in range(width)],
        )
        table = chi_squared(
            spread,
            [f"f{i}" for i in range(width)],
            "label",
            self.getOrDefault(self.featureBins),
            self.getOrDefault(self.labelBins),
        )
        scored = table.collect()  # one row per feature
        scored.sort(key=lambda r: (r["p_value"], -r["statistic"], r["feature_index"]))
        keep = sorted(r["feature_index"] for r in scored[: self.getOrDefault(self.numTopFeatures)])
        return VectorSlicer(inputCol=source, outputCol=self.getOutputCol(), indices=keep)


def chi_squared(
    df: DataFrame, features: Sequence[str], label: str, feature_bins: int = 0, label_bins: int = 10
) -> DataFrame:
    """One row per feature: index, statistic, degrees of freedom and p-value.

    Contingency counts are combined per task; what is shuffled is bounded by bins, not rows.
    """
    stages, test_columns, test_label = [], list(features), label
    if feature_bins:
        test_columns = [f"{c}_bin" for c in features]
        stages.append(
            QuantileDiscretizer(
                inputCols=list(features), outputCols=test_columns, numBuckets=feature_bins, relativeError=0.001
            )
        )
    if label_bins:
        test_label = f"{label}_bin"
        stages.append(quantile_discretizer(label, label_bins, test_label))
    stages.append(assembler(test_columns, "_tested"))
    # Neighbours are joined where there are more partitions; the error bound of a sketch is the same.
    tested = Pipeline(stages=stages).fit(df.coalesce(_SKETCHES)).transform(df)
    return ChiSquareTest.test(tested, "_tested", test_label, flatten=True).select(
        F.col("featureIndex").alias("feature_index"),
        "statistic",
        F.col("degreesOfFreedom").alias("degrees_of_freedom"),
        F.col("pValue").alias("p_value"),
    )


def f_statistics(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row per feature with the F statistic of its linear regression on the label; one pass."""
    seen = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.corr(quoted(c), quoted(label)).alias(f"r{i}") for i, c in enumerate(features)]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r")) for i, c in enumerate(features)])
    explained = F.col("r") * F.col("r")
    return seen.select("n", F.inline(entries)).select(
        "feature", (explained / (1 - explained) * (F.col("n") - 2)).alias("f_value")
    )


def spread_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per element."""
    array = vector_to_array(F.col(quoted(vector)))
    others = [quoted(c) for c in df.columns if c != vector and c not in names]
    return df.select(*others, *[array[i].alias(name) for i, name in enumerate(names)])
