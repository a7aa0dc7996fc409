"""What counts as a missing value.

A float NaN is missing, as in the dataframe libraries analysts come from; Spark
itself treats it as a number, so statistics go through ``present`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def _is_float(dtype: DataType) -> bool:
    return isinstance(dtype, (FloatType, DoubleType))


def is_missing(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    if _is_float(df.schema[name].dataType):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null."""
    column = F.col(quoted(name))
    if _is_float(df.schema[name].dataType):
        return F.nanvl(column, F.lit(None).cast(df.schema[name].dataType))
    return column


def quoted(name: str) -> str:
    """Column reference that survives dots and leading digits in the name."""
    return "`" + name.replace("`", "``") + "`"
