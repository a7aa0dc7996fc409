"""Shape, missing-value profiles and the completeness gate."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gablework.functions.missing import is_missing, present, quoted
from gablework.sources.scratch import materialize


class IncompleteData(ValueError):
    """Columns that had to be complete hold missing values."""


def _missing_by_column(df: DataFrame) -> DataFrame:
    """One row per column from one aggregate over the data; nothing is collected."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select("n_rows", F.inline(entries))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_profile(df: DataFrame) -> DataFrame:
    """Percentage missing per column, complete columns left out, ascending."""
    percent = F.col("n_missing") / F.col("n_rows") * 100
    return (
        _missing_by_column(df)
        .filter(F.col("n_missing") > 0)
        .select("column_name", percent.alias("pct_missing"))
        .orderBy("pct_missing", "column_name")
    )


def null_counts(df: DataFrame, top: int = 5) -> DataFrame:
    """The columns with most missing values, complete ones included."""
    return (
        _missing_by_column(df)
        .select("column_name", "n_missing")
        .orderBy(F.desc("n_missing"), "column_name")
        .limit(top)
    )


class CompletenessGate:
    """Counts missing values of named columns while the rows flow to wherever they are used.

    Use ``frame`` in place of the rows, and call ``check`` after the action that reads it; there is no pass of its own.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str] | None = None):
        self.columns = list(df.columns if columns is None else columns)
        self._seen = Observation(f"complete-{uuid.uuid4().hex}")
        holes = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(self.columns)]
        self.frame = df.observe(self._seen, *holes) if holes else df

    def missing(self) -> dict[str, int]:
        """Columns with missing values and how many; waits for the first action on ``frame``."""
        seen = self._seen.get if self.columns else {}
        return {c: seen[f"m{i}"] for i, c in enumerate(self.columns) if seen[f"m{i}"]}

    def check(self) -> None:
        if holes := self.missing():
            raise IncompleteData(", ".join(f"{c}: {n}" for c, n in holes.items()))


def require_complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows, written while they are counted, or an error that names all columns with missing values.

    The input is read once; what is returned reads the written rows.
    """
    gate = CompletenessGate(df, columns)
    written = materialize(gate.frame, "complete")
    gate.check()
    return written


def sparse_columns(df: DataFrame, min_share: float = 0.8) -> list[str]:
    """Columns whose share of non-missing values is below ``min_share``."""
    seen = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(present(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    ).first()
    needed = seen["n_rows"] * min_share
    return [c for i, c in enumerate(df.columns) if seen[f"c{i}"] < needed]


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of ``value`` per ``key``, lowest first. Rows without a key form no group."""
    return (
        df.filter(~is_missing(df, key))
        .groupBy(quoted(key))
        .agg(F.avg(present(df, value)).alias(f"mean_{value}"))
        .orderBy(f"mean_{value}", quoted(key))
    )
