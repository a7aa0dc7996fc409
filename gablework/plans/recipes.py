"""Regression recipes as Spark ML pipelines, every seed explicit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame

from gablework.functions.missing import quoted
from gablework.functions.spreading import spread_rows
from gablework.operators import features as ft
from gablework.sources.scratch import checkpointed

SEED = 666


@dataclass(frozen=True)
class Inputs:
    """What a recipe is told about the table.

    ``discretize`` names a feature that is also cut into 20 quantile buckets. As the
    buckets replace it, it is left out of the assembled features, unless
    ``keep_discretized`` asks for raw column and no buckets in the vector, which is what
    the published scores were made with.
    """

    columns: Sequence[str]
    label: str
    discretize: str | None = None
    keep_discretized: bool = False
    buckets: int = 20
    top: int = 16
    components: int = 9
    scale_before_pca: bool = False
    seed: int = SEED

    def discretized_stages(self) -> list:
        if self.discretize is None:
            return [ft.assembler(self.columns)]
        buckets = ft.quantile_discretizer(self.discretize, self.buckets)
        if self.keep_discretized:
            return [buckets, ft.assembler(self.columns)]
        used = [buckets.getOutputCol() if c == self.discretize else c for c in self.columns]
        return [buckets, ft.assembler(used)]


# Spark's default trees; these settings change the passes over the data, not the model:
# room for all nodes of a level at once, and rows remember their node between levels.
TREE_MEMORY_MB = 512


def forest(inputs: Inputs, features: str) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=features,
        labelCol=inputs.label,
        seed=inputs.seed,
        maxMemoryInMB=TREE_MEMORY_MB,
        cacheNodeIds=True,
    )


def boosted_trees(inputs: Inputs, features: str) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=features, labelCol=inputs.label, seed=inputs.seed, maxMemoryInMB=TREE_MEMORY_MB
    )


@dataclass(frozen=True)
class Recipe:
    """Feature stages and the regressor, apart, so that tuning can fit the first once."""

    prepare: Pipeline
    regressor: RandomForestRegressor | GBTRegressor

    def stages(self) -> list:
        return [*self.prepare.getStages(), self.regressor]

    def pipeline(self) -> Pipeline:
        return Pipeline(stages=self.stages())


def raw_forest(inputs: Inputs) -> Recipe:
    return Recipe(Pipeline(stages=[ft.assembler(inputs.columns)]), forest(inputs, ft.FEATURES))


def raw_boosting(inputs: Inputs) -> Recipe:
    return Recipe(Pipeline(stages=[ft.assembler(inputs.columns)]), boosted_trees(inputs, ft.FEATURES))


def standardized_forest(inputs: Inputs) -> Recipe:
    stages = [*inputs.discretized_stages(), ft.standard_scaler()]
    return Recipe(Pipeline(stages=stages), forest(inputs, ft.SCALED))


def minmax_forest(inputs: Inputs) -> Recipe:
    stages = [*inputs.discretized_stages(), ft.minmax_scaler()]
    return Recipe(Pipeline(stages=stages), forest(inputs, ft.SCALED))


def selected_forest(inputs: Inputs) -> Recipe:
    """Top features by F-test, standardized."""
    return _selected(inputs, ft.f_test_selector(inputs.label, inputs.top))


def selected_boosting(inputs: Inputs) -> Recipe:
    """Boosted trees on the top features by F-test."""
    stages = [ft.assembler(inputs.columns), ft.f_test_selector(inputs.label, inputs.top)]
    return Recipe(Pipeline(stages=stages), boosted_trees(inputs, ft.SELECTED))


def chi_squared_forest(inputs: Inputs) -> Recipe:
    """Top features by chi-squared over quantile bins, standardized."""
    return _selected(inputs, ft.ChiSquaredSelector(labelCol=inputs.label, numTopFeatures=inputs.top))


def _selected(inputs: Inputs, selector) -> Recipe:
    stages = [*inputs.discretized_stages(), selector, ft.standard_scaler(ft.SELECTED)]
    return Recipe(Pipeline(stages=stages), forest(inputs, ft.SCALED))


def projected_forest(inputs: Inputs) -> Recipe:
    stages = [ft.assembler(inputs.columns), *ft.pca_stages(inputs.components, inputs.scale_before_pca)]
    return Recipe(Pipeline(stages=stages), forest(inputs, ft.PROJECTED))


def of_depth_one(recipe: Recipe, rounds: int = 3, bins: int = 64) -> Recipe:
    """The recipe with one tree of one split in place of its forest, or ``rounds`` of them boosted.

    Such a model is exact: every row is used, every feature tried, and every border between values if a
    feature has fewer than ``bins``. It checks a recipe's other steps against plain sums.
    """
    model = recipe.regressor
    sizes = {model.maxDepth: 1, model.maxBins: bins}
    if isinstance(model, GBTRegressor):
        sizes[model.maxIter] = rounds
    else:
        sizes |= {model.numTrees: 1, model.bootstrap: False, model.featureSubsetStrategy: "all"}
    return Recipe(recipe.prepare, model.copy(sizes))


# Parameters of a regressor that may name columns besides its features and label.
_FURTHER = ("weightCol", "validationIndicatorCol")

RECIPES: dict[str, Callable[[Inputs], Recipe]] = {
    "forest": raw_forest,
    "boosting": raw_boosting,
    "forest_standardized": standardized_forest,
    "forest_minmax": minmax_forest,
    "forest_selected": selected_forest,
    "forest_chi_squared": chi_squared_forest,
    "forest_pca": projected_forest,
}


def stable_rows(df: DataFrame, rows: int | None = None, partitions: int | None = None) -> DataFrame:
    """Training rows in a partitioning that depends on the data alone, written for reuse.

    Trees draw their samples partition by partition in row order, so equal seeds give
    equal models only over equal partitions. How many there are follows from ``rows``, an upper
    bound of the row count (counted if not given), and not from the session; ``partitions``
    overrides it. One shuffle buys that for all fits, which read the partitions as they were written.
    """
    return checkpointed(spread_rows(df, rows, partitions))


def fit_recipe(recipe: Recipe, train: DataFrame, setting: Mapping[Param, Any] | None = None) -> PipelineModel:
    """The recipe's pipeline, fitted; ``setting`` replaces parameters of its stages.

    Growing trees reads the rows once to describe them, once to find candidate splits and once to bin them,
    so what the regressor reads is written meanwhile; memory is left to the binned rows.
    """
    *stages, regressor = [stage.copy(setting) for stage in recipe.stages()]
    prepared = Pipeline(stages=stages).fit(train)
    read = [regressor.getFeaturesCol(), regressor.getLabelCol()]
    read += [regressor.getOrDefault(name) for name in _FURTHER if regressor.hasParam(name) and regressor.isDefined(name)]
    fitting = prepared.transform(train).select(*map(quoted, dict.fromkeys(c for c in read if c)))
    fitting = fitting.persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([*prepared.stages, regressor.fit(fitting)])
    finally:
        fitting.unpersist()
