"""One query per operator over the Parquet tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from gablework.functions.numbers import is_open_ended, parse_number_text
from gablework.operators import combine, encode, evaluate, impute, profile, shape, split
from gablework.operators import features as ft
from gablework.operators.histogram import histogram
from gablework.plans import recipes as rc
from gablework.plans import tuning
from gablework.plans.document_cleaning import clean_documents
from gablework.sources.delimited import PANDAS, READR, Dialect, read_delimited, write_delimited
from gablework.sources.scratch import fresh_path
from gablework.sources.tables import (
    LINEITEM_FEATURES,
    LINEITEM_KEY,
    LINEITEM_LABEL,
    labelled_documents,
    lineitem_features,
    priced_lineitem,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FOUR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LOOKBACK = ("doc_id", "lang", "quality", "toxic", "grade")


def query(build: Query, name: str | None = None) -> Query:
    QUERIES[name or build.__name__] = build
    return build


def rounded(names, digits: int) -> dict[str, Column]:
    return {name: F.round(name, digits) for name in names}


# ---- scans ---------------------------------------------------------------------------


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a CSV with two kinds of missing token, read back with inferred types."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Id"),
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        F.to_date("o_orderdate").cast("string").alias("order_day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NA").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return read_delimited(spark, write_delimited(orders, fresh_path(spark, "csv_scan")), dialect=PANDAS)


@query
def csv_scan_named(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a CSV whose header is replaced by the declared names."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    path = write_delimited(customers, fresh_path(spark, "csv_scan_named"))
    return read_delimited(spark, path, schema="Id bigint, Balance double")


@query
def csv_scan_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as people write them (currency, thousands marks, open-ended counts, blanks)."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("part"),
        F.when(F.col("p_size") > 40, F.concat(F.col("p_size").cast("string"), F.lit("+")))
        .when(F.col("p_size") > 1, F.col("p_size").cast("string"))
        .alias("size"),
        F.format_number(F.col("p_partkey") + 10_000, 0).alias("stock"),
        F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") * 100, 2)).alias("price"),
    )
    path = write_delimited(parts, fresh_path(spark, "csv_scan_dirty"))
    return read_delimited(spark, path, dialect=READR).select(
        F.col("part").cast("long").alias("part"),
        parse_number_text(F.col("size")).alias("size"),
        is_open_ended(F.col("size")).alias("plus"),
        F.col("stock").alias("stock"),
        parse_number_text(F.col("price")).alias("price"),
    )


@query
def csv_scan_readr(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text with T and F, dates, times of day and date-times, typed by what every value is."""
    orders = table(spark, folder, "orders")
    at = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)")
    text = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", "T").when(F.col("o_orderstatus") == "F", "F").otherwise("NA").alias("open"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("day"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format(at, "HH:mm")).otherwise(F.date_format(at, "h:mm:ss a")).alias("clock"),
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(at, "yyyy-MM-dd"))
        .alias("moment"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    path = write_delimited(text, fresh_path(spark, "csv_scan_readr"))
    return read_delimited(spark, path, dialect=READR).select(
        "id",
        "open",
        F.datediff("day", F.lit("1990-01-01").cast("date")).alias("days"),
        F.col("clock").alias("seconds"),
        F.unix_timestamp("moment").alias("moment"),
        "month",
    )


@query
def csv_scan_semicolon(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    path = write_delimited(suppliers, fresh_path(spark, "csv_scan_semicolon"), sep=";")
    return read_delimited(spark, path, dialect=Dialect(sep=";"))


@query
def csv_scan_quoted(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts, with their line breaks and quotes, written and read back."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = write_delimited(documents, fresh_path(spark, "csv_scan_quoted"))
    return read_delimited(spark, path, schema="doc_id bigint, text string", dialect=Dialect(multi_line=True))


@query
def csv_scan_many(spark: SparkSession, folder: str) -> DataFrame:
    """Two lots of files whose headers differ in order, as one table."""
    customers = table(spark, folder, "customer")
    one = customers.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_nationkey")
    two = customers.filter(F.col("c_acctbal") < 0).select("c_nationkey", "c_custkey")
    return read_delimited(spark, [write_delimited(df, fresh_path(spark, "csv_scan_many")) for df in (one, two)])


@partial(query, name="parse_number_text")
def parse_balances(spark: SparkSession, folder: str) -> DataFrame:
    """Formatted account balances back to numbers; a few forms are no number at all."""
    customers = table(spark, folder, "customer")
    grouped = F.format_number("c_acctbal", 2)
    text = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("$"), grouped))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.col("c_acctbal").cast("string"), F.lit("+")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("n/a"))
        .otherwise(grouped)
    )
    return customers.select(
        "c_custkey", parse_number_text(text).alias("balance"), is_open_ended(text).alias("plus")
    )


# ---- shape ---------------------------------------------------------------------------


@query
def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder)
    kept = shape.drop_sparse(documents)
    dropped = len(documents.columns) - len(kept.columns)
    return profile.table_shape(documents).withColumn("n_dropped", F.lit(dropped))


@query
def drop_sparse_cols(spark: SparkSession, folder: str) -> DataFrame:
    return shape.drop_sparse(labelled_documents(spark, folder))


@query
def drop_cols(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").drop("o_custkey", "o_orderdate", "o_orderpriority")


ORDER_SCHEMA = "pedido BIGINT NOT NULL, cliente INT NOT NULL, estado STRING NOT NULL, importe FLOAT NOT NULL"
ORDER_SOURCES = {
    "pedido": "o_orderkey",
    "cliente": "o_custkey",
    "estado": "o_orderstatus",
    "importe": "o_totalprice",
}


@query
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    schema = _parse_datatype_string(ORDER_SCHEMA)
    conformed = shape.conform_schema(table(spark, folder, "orders"), schema, ORDER_SOURCES)
    return conformed.withColumn("importe", F.col("importe").cast("double"))


@query
def select_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return shape.select_numeric(labelled_documents(spark, folder))


@query
def select_strings(spark: SparkSession, folder: str) -> DataFrame:
    return shape.select_strings(table(spark, folder, "part"))


@query
def derive_cols(spark: SparkSession, folder: str) -> DataFrame:
    derived = shape.derive(
        table(spark, folder, "lineitem"),
        {
            "total": shape.total_of("l_quantity", "l_extendedprice", "l_tax"),
            "half_weighted": F.col("l_quantity") + F.col("l_linenumber") * 0.5,
            "midpoint": (F.col("l_discount") + F.col("l_tax")) / 2,
        },
        drop=["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    moved = shape.move_last(derived, "l_extendedprice", "price")
    return moved.withColumns(rounded(["total", "half_weighted", "midpoint"], 6))


@query
def preview_topk(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    return shape.preview(parts, [F.desc("p_retailprice"), F.asc("p_partkey")], 5)


# ---- profiles and aggregates ---------------------------------------------------------


@query
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.null_profile(labelled_documents(spark, folder))
    return found.withColumn("pct_missing", F.round("pct_missing", 6))


@query
def null_counts_top5(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(labelled_documents(spark, folder), 5)


@query
def complete_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their gaps filled, through the gate that would name any column still with gaps."""
    documents = labelled_documents(spark, folder).select(*LOOKBACK)
    filled = impute.fill_literal(impute.fill_zero(documents, ["quality", "toxic"]))
    return profile.require_complete(filled)


@query
def group_mean_sorted(spark: SparkSession, folder: str) -> DataFrame:
    means = profile.group_mean(table(spark, folder, "part"), "p_brand", "p_retailprice")
    return means.withColumn("mean_p_retailprice", F.round("mean_p_retailprice", 6))


@query
def rmse_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Error on the hold-out of predicting the training mean for every row."""
    train, test = split.hash_split(priced_lineitem(spark, folder), LINEITEM_KEY)
    mean = train.agg(F.avg(LINEITEM_LABEL)).first()[0]
    scored = test.withColumn("prediction", F.lit(mean))
    return evaluate.rmse_by(scored, LINEITEM_LABEL).withColumn("rmse", F.round("rmse", 4))


@query
def rmse_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """Error per ship year of taking the list price for the amount paid."""
    rows = priced_lineitem(spark, folder).withColumn("ship_year", F.year("l_shipdate"))
    found = evaluate.rmse_by(rows, LINEITEM_LABEL, "l_extendedprice", by=["ship_year"])
    return found.withColumn("rmse", F.round("rmse", 4))


@partial(query, name="histogram")
def histogram_width(spark: SparkSession, folder: str) -> DataFrame:
    found = histogram(table(spark, folder, "lineitem"), "l_extendedprice", width=2500.0)
    return found.withColumns(rounded(["lower", "upper"], 6))


@query
def histogram_rounded(spark: SparkSession, folder: str) -> DataFrame:
    """Class count and edges from the data: Sturges' rule and round numbers."""
    found = histogram(table(spark, folder, "lineitem"), "l_quantity")
    return found.withColumns(rounded(["lower", "upper"], 6))


# ---- combining -----------------------------------------------------------------------


@query
def attach_target(spark: SparkSession, folder: str) -> DataFrame:
    """Two projections of orders, each lacking rows the other has, aligned on the key."""
    orders = table(spark, folder, "orders")
    features = orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey")
    target = orders.filter(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "o_totalprice")
    return combine.attach_target(features, target, "o_orderkey")


@query
def stack_datasets(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    early = F.year("o_orderdate") < 1998
    first = orders.filter(early).select("o_orderkey", "o_custkey", "o_totalprice")
    second = orders.filter(~early).select("o_orderkey", "o_orderpriority", "o_custkey")
    return combine.stack({"first": first, "second": second})


# ---- imputation ----------------------------------------------------------------------


@query
def fill_zero(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder).select(*LOOKBACK)
    return impute.fill_zero(documents, ["quality", "toxic"])


@query
def fill_mean(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder).select(*LOOKBACK)
    filled = impute.fit_fills(documents, mean=["quality", "toxic"]).apply(documents)
    return filled.withColumns(rounded(["quality", "toxic"], 6))


@query
def fill_median(spark: SparkSession, folder: str) -> DataFrame:
    """Orders' totals exist for some rows only; the rest take the exact median."""
    orders = table(spark, folder, "orders")
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    partly = orders.select("o_orderkey", known.alias("o_totalprice"))
    filled = impute.fit_fills(partly, median=["o_totalprice"]).apply(partly)
    return filled.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query
def fill_literal(spark: SparkSession, folder: str) -> DataFrame:
    return impute.fill_literal(labelled_documents(spark, folder).select(*LOOKBACK))


@query
def ffill(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder).select(*LOOKBACK)
    return impute.fill_along(documents, ["quality", "toxic", "grade"], ["doc_id"])


@query
def bfill(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder).select(*LOOKBACK)
    return impute.fill_along(documents, ["quality", "toxic", "grade"], ["doc_id"], direction="backward")


# ---- encoding ------------------------------------------------------------------------

PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}


@query
def encode_mapping(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return encode.encode_mapping(orders, "o_orderpriority", PRIORITY_CODES, "priority_code")


@query
def encode_mapping_int(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_size")
    return encode.encode_mapping(parts, "p_size", {size: 2 * size for size in range(1, 26)}, "size_code")


@query
def encode_target_order(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    return encode.fit_target_order(parts, "p_brand", "p_retailprice").apply(parts, "brand_code")


@query
def encode_target_order_large(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking that stays distributed, whatever the number of customers."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    ranking = encode.fit_target_order(orders, "o_custkey", "o_orderkey", most_broadcast=0)
    return ranking.apply(orders, "customer_code")


# ---- splits --------------------------------------------------------------------------


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    train, test = split.hash_split(orders, ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def hash_kfold(spark: SparkSession, folder: str) -> DataFrame:
    return split.with_fold(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


# ---- features ------------------------------------------------------------------------


def _four(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*LINEITEM_KEY, *FOUR)


@query
def assemble(spark: SparkSession, folder: str) -> DataFrame:
    vectors = ft.assembler(FOUR).transform(_four(spark, folder)).select(*LINEITEM_KEY, ft.FEATURES)
    return ft.spread_vector(vectors, ft.FEATURES, ["f0", "f1", "f2", "f3"])


@query
def quantile_bucket(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty equal-depth buckets from exact cut points, described by their contents."""
    lines = table(spark, folder, "lineitem").select("l_extendedprice")
    bucketed = ft.fit_exact_buckets(lines, "l_extendedprice", 20, "bucket").transform(lines)
    return bucketed.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
    )


@query
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, ft.standard_scaler())


@query
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, ft.minmax_scaler())


def _scaled(spark: SparkSession, folder: str, scaler) -> DataFrame:
    rows = _four(spark, folder)
    model = Pipeline(stages=[ft.assembler(FOUR), scaler]).fit(rows)
    scaled = ft.spread_vector(model.transform(rows).select(*LINEITEM_KEY, ft.SCALED), ft.SCALED, FOUR)
    return scaled.withColumns(rounded(FOUR, 6))


TESTED = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


@query
def chi2_stat(spark: SparkSession, folder: str) -> DataFrame:
    """Chi-squared of four discrete features against the decile of the amount paid."""
    rows = priced_lineitem(spark, folder).select(*TESTED, LINEITEM_LABEL)
    binned = ft.fit_exact_buckets(rows, LINEITEM_LABEL, 10, "decile").transform(rows)
    names = F.array(*map(F.lit, TESTED))
    return ft.chi_squared(binned, TESTED, "decile", label_bins=0).select(
        F.get(names, F.col("feature_index")).alias("feature"),
        F.round("statistic", 4).alias("statistic"),
        F.col("degrees_of_freedom").cast("long").alias("degrees_of_freedom"),
    )


@query
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    """F statistic of every feature, and which five the selector keeps.

    On a log scale, because ``1 - r²`` loses digits where the fit is nearly perfect.
    """
    rows = lineitem_features(spark, folder)
    assembled = ft.assembler(LINEITEM_FEATURES).transform(rows).select(ft.FEATURES, LINEITEM_LABEL)
    keep = ft.f_test_selector(LINEITEM_LABEL, 5).fit(assembled).selectedFeatures
    return ft.f_statistics(rows, LINEITEM_FEATURES, LINEITEM_LABEL).select(
        "feature",
        F.round(F.log10("f_value"), 8).alias("log10_f"),
        F.col("feature").isin(*[LINEITEM_FEATURES[i] for i in keep]).alias("kept"),
    )


@query
def pca_project(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem_features(spark, folder)
    model = Pipeline(stages=[ft.assembler(LINEITEM_FEATURES), *ft.pca_stages(3, scale_first=True)]).fit(rows)
    projected = model.transform(rows).select(*LINEITEM_KEY, ft.PROJECTED)
    names = ["pc1", "pc2", "pc3"]
    return ft.spread_vector(projected, ft.PROJECTED, names).withColumns(rounded(names, 6))


# ---- models --------------------------------------------------------------------------


def _inputs() -> rc.Inputs:
    return rc.Inputs(
        columns=LINEITEM_FEATURES, label=LINEITEM_LABEL, discretize="l_extendedprice", top=5, components=3
    )


def _train_and_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    train, test = split.hash_split(lineitem_features(spark, folder), LINEITEM_KEY)
    rows = table(spark, folder, "lineitem").count()  # from file footers
    return rc.stable_rows(split.with_fold(train, LINEITEM_KEY), rows), test


def _predictions(recipe: str) -> Query:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        train, test = _train_and_test(spark, folder)
        model = rc.fit_recipe(rc.RECIPES[recipe](_inputs()), train)
        return model.transform(test).select(*LINEITEM_KEY, LINEITEM_LABEL, "prediction")

    return build


QUERIES["rf_predict"] = _predictions("forest")
QUERIES["gbt_predict"] = _predictions("boosting")
QUERIES["rf_standardized"] = _predictions("forest_standardized")
QUERIES["rf_minmax"] = _predictions("forest_minmax")
QUERIES["rf_selected"] = _predictions("forest_selected")
QUERIES["rf_chi_squared"] = _predictions("forest_chi_squared")
QUERIES["rf_pca"] = _predictions("forest_pca")


def _tuned(recipe: rc.Recipe, columns, grid, train: DataFrame, test: DataFrame) -> DataFrame:
    """The grid's cross-validated errors, and the refitted winner's error on the hold-out."""
    found = tuning.grid_search(recipe, train, "fold", grid)
    model = tuning.refit_best(recipe, train, found)
    error = model.transform(test).agg(evaluate.rmse(LINEITEM_LABEL)).first()[0]
    return found.report(train.sparkSession, columns, error)


def _grid(name: str) -> Query:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        recipe = rc.RECIPES[name](_inputs())
        columns = {"num_trees": recipe.regressor.numTrees, "max_depth": recipe.regressor.maxDepth}
        return _tuned(recipe, columns, None, *_train_and_test(spark, folder))

    return build


QUERIES["cv_grid"] = _grid("forest_standardized")
QUERIES["cv_selected"] = _grid("forest_selected")


@query
def cv_boosting(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds and depth of boosted trees, and how many features they are given, by cross-validation."""
    recipe = rc.selected_boosting(_inputs())
    selector, trees = recipe.prepare.getStages()[-1], recipe.regressor
    columns = {"top": selector.selectionThreshold, "rounds": trees.maxIter, "max_depth": trees.maxDepth}
    grid = tuning.grid_of({columns["top"]: [3.0, 5.0], columns["rounds"]: [4, 8], columns["max_depth"]: [2, 3]})
    return _tuned(recipe, columns, grid, *_train_and_test(spark, folder))


@query
def compare_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Training and hold-out error of every recipe, fitted on one written training set."""
    train, test = _train_and_test(spark, folder)
    models = {name: rc.fit_recipe(make(_inputs()), train) for name, make in rc.RECIPES.items()}
    return tuning.compare_recipes(models, {"train": train.drop("fold"), "test": test}, LINEITEM_LABEL)


# ---- models that SQL can follow ------------------------------------------------------

STRONG = ("price_band", "l_quantity", "l_discount", "l_tax", "line_number")
WEAK = STRONG[1:]


def _stump_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows whose features have few values each."""
    rows = lineitem_features(spark, folder).select(
        *LINEITEM_KEY, LINEITEM_LABEL, *WEAK, F.floor(F.col("l_extendedprice") / 4000).cast("double").alias("price_band")
    )
    train, test = split.hash_split(rows, LINEITEM_KEY)
    return rc.stable_rows(split.with_fold(train, LINEITEM_KEY), table(spark, folder, "lineitem").count()), test


def _strong() -> rc.Inputs:
    return rc.Inputs(columns=STRONG, label=LINEITEM_LABEL)


def _weak(top: int) -> rc.Inputs:
    return rc.Inputs(columns=WEAK, label=LINEITEM_LABEL, top=top)


def _scored(recipe: rc.Recipe, train: DataFrame, test: DataFrame, name: str = "prediction") -> DataFrame:
    scored = rc.fit_recipe(rc.of_depth_one(recipe), train).transform(test)
    return scored.select(*test.columns, F.round("prediction", 4).alias(name))


@query
def rf_stump(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(rc.raw_forest(_strong()), *_stump_parts(spark, folder))
    return scored.select(*LINEITEM_KEY, "prediction")


@query
def rf_stump_scaled(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling moves a split's place but not what it separates."""
    train, test = _stump_parts(spark, folder)
    scored = _scored(rc.standardized_forest(_strong()), train, test, "standardized")
    return _scored(rc.minmax_forest(_strong()), train, scored, "minmax").select(*LINEITEM_KEY, "standardized", "minmax")


@query
def rf_stump_selected(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(rc.selected_forest(_weak(1)), *_stump_parts(spark, folder))
    return scored.select(*LINEITEM_KEY, "prediction")


@query
def gbt_stumps(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(rc.raw_boosting(_strong()), *_stump_parts(spark, folder))
    return scored.select(*LINEITEM_KEY, "prediction")


@query
def cv_stump_grid(spark: SparkSession, folder: str) -> DataFrame:
    recipe = rc.of_depth_one(rc.raw_boosting(_strong()))
    columns = {"rounds": recipe.regressor.maxIter, "step": recipe.regressor.stepSize}
    grid = tuning.grid_of({columns["rounds"]: [1, 2], columns["step"]: [0.1, 0.5]})
    return _tuned(recipe, columns, grid, *_stump_parts(spark, folder)).withColumns(rounded(["avg_rmse", "holdout_rmse"], 4))


@query
def cv_stump_selected(spark: SparkSession, folder: str) -> DataFrame:
    """How many features the selection keeps, tuned; folds select for themselves."""
    recipe = rc.of_depth_one(rc.selected_forest(_weak(1)))
    columns = {"top": recipe.prepare.getStages()[1].selectionThreshold}
    found = _tuned(recipe, columns, tuning.grid_of({columns["top"]: [1.0, 4.0]}), *_stump_parts(spark, folder))
    return found.withColumns(rounded(["avg_rmse", "holdout_rmse"], 4))


@query
def compare_stumps(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _stump_parts(spark, folder)
    recipes = {
        "stump": rc.raw_forest(_strong()),
        "stump_minmax": rc.minmax_forest(_strong()),
        "boosted_stumps": rc.raw_boosting(_strong()),
    }
    models = {name: rc.fit_recipe(rc.of_depth_one(recipe), train) for name, recipe in recipes.items()}
    report = tuning.compare_recipes(models, {"train": train.drop("fold"), "test": test}, LINEITEM_LABEL)
    return report.withColumn("rmse", F.round("rmse", 4))


@query
def pca_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Both components of two columns, signs left aside, and their shares of the variance."""
    rows = table(spark, folder, "lineitem").select(*LINEITEM_KEY, "l_quantity", "l_extendedprice")
    model = Pipeline(stages=[ft.assembler(["l_quantity", "l_extendedprice"]), *ft.pca_stages(2)]).fit(rows)
    projected = ft.spread_vector(model.transform(rows).select(*LINEITEM_KEY, ft.PROJECTED), ft.PROJECTED, ["first", "second"])
    shares = model.stages[-1].explainedVariance.toArray().tolist()
    return projected.select(
        *LINEITEM_KEY,
        *[F.round(F.abs(c), 4).alias(c) for c in ("first", "second")],
        *[F.round(F.lit(s), 8).alias(f"{c}_share") for c, s in zip(("first", "second"), shares)],
    )


# ---- the chain -----------------------------------------------------------------------


@query
def clean_chain(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean_documents(spark, folder)
    return cleaned.withColumns(rounded(["quality", "weight"], 6))
