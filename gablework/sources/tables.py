"""The Parquet tables and the derived inputs that the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, with nulls where no label exists.

    ``grade`` is the label as text, so that string imputation has nulls to fill too.
    """
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    grade = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return documents.join(labels, "doc_id", "left").withColumn("grade", grade)


# What identifies a lineitem row for splitting; the order key alone could be hot.
LINEITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINEITEM_LABEL = "net"


def priced_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` with the amount a customer pays, the label of the model queries."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, folder, "lineitem").withColumn(LINEITEM_LABEL, net)


LINEITEM_FEATURES = (
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "line_number",
    "unit_price",
    "ship_year",
    "ship_month",
    "is_returned",
    "is_open",
)


def lineitem_features(spark: SparkSession, folder: str) -> DataFrame:
    """Row key, numeric features and label; nothing else is read from the scan."""
    return priced_lineitem(spark, folder).select(
        *LINEITEM_KEY,
        *LINEITEM_FEATURES[:4],
        F.col("l_linenumber").cast("double").alias("line_number"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.year("l_shipdate").cast("double").alias("ship_year"),
        F.month("l_shipdate").cast("double").alias("ship_month"),
        (F.col("l_returnflag") == "R").cast("double").alias("is_returned"),
        (F.col("l_linestatus") == "O").cast("double").alias("is_open"),
        F.col(LINEITEM_LABEL),
    )
