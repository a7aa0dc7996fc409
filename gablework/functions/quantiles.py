"""Exact order statistics by radix selection, in the column's own type.

Spark's ``median`` and ``percentile`` keep every distinct value of a column in one
aggregation buffer, which a continuous column at cluster scale does not fit, and turn
whole numbers and decimals into doubles. Here values are ordered by whole-number keys (a
whole number itself, the unscaled digits of a decimal, the sortable bits of a double),
and a wanted rank is looked for in ever narrower key intervals:

1. One aggregate counts each column and brackets each probability by a sketch.
2. One aggregate counts, exactly, what lies below and inside each bracket.
3. Each further round cuts an open interval's keys into 32 equal cells and counts the
   rows per cell, with the least and greatest value found there. The rank falls into one
   cell; it is found when that holds a single value, however many rows share it.

Rows outside the open intervals are not counted again, so after the brackets a round
counts a few rows in ten thousand. A task's table has at most 32 rows per open
interval, of less than 100 bytes each: for the two middle ranks of 300 columns 2 MB,
whatever the rows. No value is collected, and no row is shuffled but those tables.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, LongType

from gablework.functions.missing import present

CELLS = 32
# Share of the rows on either side of a rank that its bracket takes in, and the sketch's accuracy.
_SLACK, _ACCURACY = 2e-4, 10_000
_WIDE = Context(prec=100)


@dataclass(frozen=True)
class KeyOrder:
    """How values of one type are compared and cut: a type without loss, and whole-number keys."""

    dtype: DataType

    @classmethod
    def of(cls, dtype: DataType) -> KeyOrder:
        if isinstance(dtype, (IntegralType, BooleanType)):
            return cls(LongType())
        if isinstance(dtype, (FloatType, DoubleType)):
            return cls(DoubleType())
        if isinstance(dtype, DecimalType):
            return cls(dtype)
        raise TypeError(f"no order statistics of {dtype.simpleString()}")

    def key(self, value: Any) -> int:
        if isinstance(self.dtype, DoubleType):
            bits = struct.unpack(">q", struct.pack(">d", value + 0.0))[0]
            return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)
        if isinstance(self.dtype, DecimalType):
            return int(value.scaleb(self.dtype.scale, _WIDE))
        return value

    def value(self, key: int) -> Any:
        if isinstance(self.dtype, DoubleType):
            size = struct.unpack(">d", struct.pack(">Q", abs(key)))[0]
            return size if key >= 0 else -size
        if isinstance(self.dtype, DecimalType):
            return Decimal(key).scaleb(-self.dtype.scale, _WIDE)
        return key

    def text(self, value: Any) -> str:
        """A value in SQL; as text, which every value of these types survives."""
        return f"CAST('{value}' AS {self.dtype.simpleString()})"

    def of_column(self, df: DataFrame, name: str) -> Column:
        """The column without missing values, in this order's type."""
        value = present(df, name)
        return (value.cast("int") if isinstance(df.schema[name].dataType, BooleanType) else value).cast(self.dtype)

    def cell(self, column: str, cuts: Sequence, first: int = 0) -> str:
        """SQL for the number of cuts at or below the column, by halving."""
        if not cuts:
            return str(first)
        mid = len(cuts) // 2
        below, above = self.cell(column, cuts[:mid], first), self.cell(column, cuts[mid + 1 :], first + mid + 1)
        return f"if({column} < {self.text(cuts[mid])}, {below}, {above})"

    def cuts(self, low: Any, high: Any, cells: int) -> list:
        """Values that cut the keys above ``low`` up to ``high`` into ``cells`` equal ranges."""
        first, span = self.key(low), self.key(high) - self.key(low)
        keys = sorted({first + max(1, span * i // cells) for i in range(1, cells)} | ({first + span} if span < cells else set()))
        return [self.value(k) for k in keys]


@dataclass
class _Search:
    """One wanted rank among the rows of a column from ``low`` to ``high``."""

    slot: int
    rank: int
    low: Any
    high: Any

    @property
    def found(self) -> bool:
        return self.low == self.high

    def interval(self) -> tuple:
        return (self.slot, self.low, self.high)

    def narrow(self, cells: Sequence[tuple[int, Any, Any]]) -> None:
        """Go on in the cell the rank falls into; each is (rows, lower, upper end), in order."""
        for rows, low, high in cells:
            if self.rank < rows:
                self.low, self.high = low, high
                return
            self.rank -= rows
        raise RuntimeError("the values changed between two passes over them")


def _bracket(values: DataFrame, orders: Sequence[KeyOrder], brackets: Mapping[tuple, list[_Search]]) -> None:
    """Count below and inside each ``(slot, low, high)``; its searches go on in the part they fall into."""
    counts = []
    for i, (slot, low, high) in enumerate(brackets):
        counts += [F.expr(f"count_if(v{slot} < {orders[slot].text(low)}) AS b{i}"), F.expr(f"count_if(v{slot} <= {orders[slot].text(high)}) AS u{i}")]
    seen = values.agg(*counts).first()
    for i, ((slot, low, high), searches) in enumerate(brackets.items()):
        order, below, upto = orders[slot], seen[f"b{i}"], seen[f"u{i}"]
        for s in searches:
            before, after = order.value(order.key(low) - 1), order.value(order.key(high) + 1)
            s.narrow([(below, s.low, before), (upto - below, low, high), (s.rank + 1, after, s.high)])


def _cut_cells(values: DataFrame, orders: Sequence[KeyOrder], searches: list[_Search], cells: int) -> None:
    """One round: the tables of all open intervals, from one aggregate per type."""
    kinds: dict[KeyOrder, list[tuple]] = {}
    for interval in dict.fromkeys(s.interval() for s in searches):
        kinds.setdefault(orders[interval[0]], []).append(interval)
    tables: dict[tuple, list[tuple]] = {}
    for order, intervals in kinds.items():
        places = []
        for number, (slot, low, high) in enumerate(intervals):
            cell = order.cell(f"v{slot}", order.cuts(low, high, cells))
            inside = f"v{slot} BETWEEN {order.text(low)} AND {order.text(high)}"
            places.append(f"if({inside}, named_struct('interval', {number}, 'cell', {cell}, 'value', v{slot}), NULL)")
        inside = values.selectExpr(f"inline(filter(array({', '.join(places)}), p -> p IS NOT NULL))")
        counted = inside.groupBy("interval", "cell").agg(F.count(F.lit(1)), F.min("value"), F.max("value"))
        for number, _, *counts in sorted((tuple(r) for r in counted.collect()), key=lambda r: r[:2]):
            tables.setdefault(intervals[number], []).append(tuple(counts))
    for search in searches:
        search.narrow(tables[search.interval()])


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    interpolate: bool = False,
    cells: int = CELLS,
) -> dict[str, list]:
    """Exact quantiles of numeric columns, missing values ignored.

    ``interpolate=False`` returns the smallest value whose cumulative share reaches the
    probability; ``True`` interpolates linearly, so 0.5 is the usual median. Whole numbers
    give ``int`` (``float`` between two of them), decimals ``Decimal``, others ``float``. A
    column without values gives ``None``.
    """
    names = list(probabilities)
    orders = [KeyOrder.of(df.schema[name].dataType) for name in names]
    values = df.select(*[order.of_column(df, name).alias(f"v{i}") for i, (name, order) in enumerate(zip(names, orders))])
    asked = [list(probabilities[name]) for name in names]
    sketches = []
    for i, some in enumerate(asked):
        ends = ", ".join(f"{e!r}D" for p in some for e in (max(0.0, p - _SLACK), min(1.0, p + _SLACK)))
        sketches += [f"count(v{i}) AS n{i}", f"min(v{i}) AS l{i}", f"max(v{i}) AS h{i}"]
        sketches += [f"percentile_approx(v{i}, array({ends}), {_ACCURACY}) AS s{i}"] if some else []
    seen = values.agg(*map(F.expr, sketches)).first()

    searches: dict[tuple[int, int], _Search] = {}
    brackets: dict[tuple, list[_Search]] = {}
    spots: list[list[tuple[int, int, Fraction]]] = []
    for i, some in enumerate(asked):
        n, low, high = seen[f"n{i}"], seen[f"l{i}"], seen[f"h{i}"]
        spots.append([_spot(p, n, interpolate) for p in some] if n else [])
        for k, spot in enumerate(spots[i]):
            for rank in spot[:2]:
                if (i, rank) not in searches:
                    search = searches[i, rank] = _Search(i, rank, low, high)
                    if not search.found:
                        brackets.setdefault((i, *seen[f"s{i}"][2 * k : 2 * k + 2]), []).append(search)
    if brackets:
        _bracket(values, orders, brackets)
    while open_ones := [s for s in searches.values() if not s.found]:
        _cut_cells(values, orders, open_ones, cells)
    return {
        name: [_between(searches[i, low].low, searches[i, high].low, weight) for low, high, weight in spots[i]]
        or [None] * len(asked[i])
        for i, name in enumerate(names)
    }


def _between(low: Any, high: Any, weight: Fraction) -> Any:
    if low == high or weight == 0:
        return low
    if isinstance(low, Decimal):
        share = _WIDE.divide(Decimal(weight.numerator), Decimal(weight.denominator))
        return _WIDE.add(low, _WIDE.multiply(_WIDE.subtract(high, low), share))
    if isinstance(low, int):
        exact = low + (high - low) * weight
        return int(exact) if exact.denominator == 1 else float(exact)
    return low + (high - low) * float(weight)


def _spot(probability: float, n: int, interpolate: bool) -> tuple[int, int, Fraction]:
    # Decimal reading of the probability keeps 0.15 * n from landing beside an integer.
    p = Fraction(str(probability))
    if interpolate:
        position = p * (n - 1)
        low = math.floor(position)
        return low, math.ceil(position), position - low
    rank = min(max(math.ceil(p * n) - 1, 0), n - 1)
    return rank, rank, Fraction(0)
