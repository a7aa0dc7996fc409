"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Context, Decimal
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, LongType

from gablework.functions.missing import present, quoted
from gablework.functions.ordering import range_blocks
from gablework.functions.quantiles import exact_quantiles
from gablework.operators.shape import string_columns


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def fill_literal(df: DataFrame, value: str = "None", columns: Sequence[str] | None = None) -> DataFrame:
    """Fill missing strings (every string column by default) with a literal."""
    columns = string_columns(df) if columns is None else list(columns)
    return df.fillna(value, subset=columns) if columns else df


@dataclass(frozen=True)
class StatisticFills:
    """Fitted fill values; a column without any value has none and stays as it is.

    Filled columns become double, as a fill may lie between whole numbers, unless
    ``keep_types``: then they keep their type exactly, and the fill is rounded to it (half to even).
    """

    values: dict[str, Any] = field(default_factory=dict)
    keep_types: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: self._filled(df, name, v) for name, v in self.values.items() if v is not None})

    def _filled(self, df: DataFrame, name: str, value: Any) -> Column:
        if not self.keep_types:
            return F.coalesce(present(df, name).cast("double"), F.lit(float(value)))
        kind = df.schema[name].dataType
        if isinstance(kind, IntegralType):
            value = round(value)
        elif isinstance(kind, DecimalType):
            value = round(Decimal(value), kind.scale)
        return F.coalesce(present(df, name), F.lit(str(value)).cast(kind))


def _exact_sum(df: DataFrame, name: str) -> Column:
    """Whole numbers and decimals add up without rounding; others as doubles."""
    kind = df.schema[name].dataType
    if isinstance(kind, IntegralType):
        return F.sum(present(df, name).cast("decimal(38,0)" if isinstance(kind, LongType) else "bigint"))
    return F.sum(present(df, name).cast(kind if isinstance(kind, DecimalType) else "double"))


def fit_fills(
    df: DataFrame, mean: Sequence[str] = (), median: Sequence[str] = (), keep_types: bool = False
) -> StatisticFills:
    """Learn means and exact medians. Fit on the training rows, apply to all."""
    values: dict[str, Any] = {}
    if mean:
        sums = [_exact_sum(df, c).alias(f"s{i}") for i, c in enumerate(mean)]
        counts = [F.count(present(df, c)).alias(f"n{i}") for i, c in enumerate(mean)]
        row = df.agg(*sums, *counts).first()
        for i, c in enumerate(mean):
            values[c] = _mean(row[f"s{i}"], row[f"n{i}"])
    if median:
        found = exact_quantiles(df, {c: [0.5] for c in median}, interpolate=True)
        values.update({c: v[0] for c, v in found.items()})
    return StatisticFills(values, keep_types)


def _mean(total: Any, n: int) -> Any:
    """A float's mean is a float; others stay exact, as a whole number, a decimal or a fraction's nearest."""
    if not n:
        return None
    if isinstance(total, float):
        return total / n
    if isinstance(total, Decimal) and total.as_tuple().exponent:
        return Context(prec=60).divide(total, Decimal(n))
    exact = Fraction(int(total), n)
    return int(exact) if exact.denominator == 1 else Context(prec=60).divide(Decimal(exact.numerator), Decimal(exact.denominator))


def fill_along(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    direction: str = "forward",
) -> DataFrame:
    """Carry the last seen value along ascending ``order_by`` into missing ones.

    ``direction="backward"`` takes the next value instead. ``order_by`` must identify
    rows, or the carried value is ambiguous. Rows are cut into order-preserving blocks;
    each block fills itself, and a missing value with nothing before it in its block
    takes the last value of the nearest earlier block, from one row per block. The
    data is shuffled once; the join with the block rows reuses that shuffle and its sort.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"direction: {direction}")
    forward = direction == "forward"
    labelled = range_blocks(df, order_by, "_block")
    # Backward is forward over the mirrored order: a frame that grows keeps its last value,
    # one that shrinks would be searched anew for every row.
    columns_by = [F.col(quoted(c)) for c in order_by]
    keys = [c.asc_nulls_first() for c in columns_by] if forward else [c.desc_nulls_last() for c in columns_by]
    nearest = F.max_by if forward else F.min_by
    within = Window.partitionBy("_block").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    order = F.struct(*[F.col(quoted(c)) for c in order_by])  # a struct also orders null keys
    ends = labelled.groupBy("_block").agg(
        *[
            nearest(present(df, c), F.when(present(df, c).isNotNull(), order)).alias(f"_end{i}")
            for i, c in enumerate(columns)
        ]
    )
    block_order = F.col("_block").asc() if forward else F.col("_block").desc()
    across = Window.orderBy(block_order).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    carried = ends.select(
        "_block",
        *[F.last(f"_end{i}", ignorenulls=True).over(across).alias(f"_carry{i}") for i in range(len(columns))],
    )
    filled = labelled.withColumns({c: F.last(present(df, c), ignorenulls=True).over(within) for c in columns})
    return (
        filled.join(carried, "_block")
        .withColumns({c: F.coalesce(F.col(quoted(c)), F.col(f"_carry{i}")) for i, c in enumerate(columns)})
        .select(*map(quoted, df.columns))
    )
