"""Choosing, deriving, renaming and typing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType, StructField, StructType

from gablework.functions.missing import is_missing, quoted
from gablework.operators.profile import sparse_columns


def drop_sparse(df: DataFrame, min_share: float = 0.8) -> DataFrame:
    """Drop columns with a smaller share of values than ``min_share``; exactly that share stays."""
    return df.drop(*sparse_columns(df, min_share))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (NumericType, BooleanType))]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*map(quoted, numeric_columns(df)))


def select_strings(df: DataFrame) -> DataFrame:
    return df.select(*map(quoted, string_columns(df)))


def feature_columns(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """All columns but the label and the excluded ones, in schema order."""
    left_out = {label, *exclude}
    return [c for c in df.columns if c not in left_out]


def total_of(*names: str) -> Column:
    total = F.col(quoted(names[0]))
    for name in names[1:]:
        total = total + F.col(quoted(name))
    return total


def derive(df: DataFrame, formulas: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """Add computed columns, then drop inputs that are no longer wanted."""
    return df.withColumns(dict(formulas)).drop(*drop)


def move_last(df: DataFrame, column: str, new_name: str) -> DataFrame:
    """Rename a column and put it last."""
    return df.withColumn(new_name, F.col(quoted(column))).drop(column)


def conform_schema(df: DataFrame, schema: StructType, sources: Mapping[str, str] | None = None) -> DataFrame:
    """Select, rename and cast to ``schema`` by column name.

    ``sources`` maps target names to source names where they differ. Fields declared
    non-null are checked row by row while the data flows, with no extra pass, and the
    resulting schema says so.
    """
    sources = sources or {}
    missing = [f.name for f in schema if sources.get(f.name, f.name) not in df.columns]
    if missing:
        raise ValueError(f"no source column for {', '.join(missing)}")
    return df.select(*[_conformed(df, sources.get(f.name, f.name), f) for f in schema])


def conform_by_position(df: DataFrame, schema: StructType) -> DataFrame:
    """The same, matching columns by position; the column counts must agree."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a schema of {len(schema)}")
    return conform_schema(df, schema, dict(zip(schema.names, df.columns)))


def _conformed(df: DataFrame, source: str, field: StructField) -> Column:
    value = F.when(~is_missing(df, source), F.col(quoted(source))).cast(field.dataType)
    if not field.nullable:
        complaint = F.raise_error(F.lit(f"column {source} is null but {field.name} may not be"))
        value = F.coalesce(value, complaint.cast(field.dataType), _any_value(field.dataType))
    return value.alias(field.name)


def _any_value(dtype: DataType) -> Column:
    """Never reached: a literal after the error marks the expression as non-null."""
    if not isinstance(dtype, (NumericType, StringType, BooleanType)):
        raise TypeError(f"non-null {dtype.simpleString()} is not supported")
    return F.lit("" if isinstance(dtype, StringType) else 0).cast(dtype)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order: a top-k, not a full sort."""
    return df.orderBy(*order_by).limit(n)
