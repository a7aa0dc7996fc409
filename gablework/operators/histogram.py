"""Counts per equal-width class."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.functions.missing import present

# A value this share of a class width above an edge still counts as on the edge.
EDGE_TOLERANCE = 1e-7


def histogram(df: DataFrame, column: str, width: float | None = None, start: float | None = None) -> DataFrame:
    """Rows ``(bin, lower, upper, n)`` over right-closed classes, the lowest edge included.

    Without ``width`` the class count follows Sturges' rule and the edges are rounded to
    1, 2 or 5 times a power of ten. With it, classes start at ``start`` (the greatest
    multiple of the width not above the minimum by default). Empty classes are listed;
    infinite values are left out.
    """
    number = present(df, column).cast("double")
    value = F.when(F.abs(number) < float("inf"), number)
    seen = df.agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).first()
    if seen["n"] == 0:
        raise ValueError(f"{column} has no values")
    if width is None:
        start, width, n_bins = round_classes(seen["low"], seen["high"], math.ceil(math.log2(seen["n"]) + 1))
    else:
        start = math.floor(seen["low"] / width) * width if start is None else start
        if seen["low"] < start:
            raise ValueError(f"values below the first edge: {seen['low']} < {start}")
        n_bins = max(1, math.ceil((seen["high"] - start) / width - EDGE_TOLERANCE))
    place = F.greatest(F.ceil((value - F.lit(start)) / F.lit(width) - F.lit(EDGE_TOLERANCE)) - 1, F.lit(0))
    counts = df.filter(value.isNotNull()).groupBy(place.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = df.sparkSession.range(n_bins).withColumnRenamed("id", "bin")
    return bins.join(counts, "bin", "left").select(
        "bin",
        (F.lit(start) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(start) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def round_classes(low: float, high: float, wanted: int) -> tuple[float, float, int]:
    """Start, width and number of classes with round edges covering ``[low, high]``.

    The width is the multiple (1, 2, 5 or 10) of a power of ten closest above the raw
    width in the sense of R's ``pretty``: a larger multiple is taken only while it is not
    too far above it.
    """
    raw = (high - low) / wanted or max(abs(low), 1.0) / wanted
    power = 10.0 ** math.floor(math.log10(raw))
    width = power
    for multiple, bias in ((2, 1.5), (5, 2.75), (10, 1.5)):
        if multiple * power - raw < bias * (raw - width):
            width = multiple * power
    first = math.floor(low / width + EDGE_TOLERANCE)
    last = math.ceil(high / width - EDGE_TOLERANCE)
    last = max(last, first + 1)
    return first * width, width, last - first
