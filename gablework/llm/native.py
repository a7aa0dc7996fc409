"""Small helpers for array expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per row.

    A lambda over an array expression re-evaluates everything it refers to for each
    element, unless that is a lambda variable itself. Binding the value as the one
    element of an array makes it one.
    """
    return F.transform(F.array(value), body)[0]


def indices(length: Column) -> Column:
    """0 .. length - 1; empty for a length below one."""
    return F.when(length > 0, F.sequence(F.lit(0), length.cast("int") - 1)).otherwise(
        F.array().cast("array<int>")
    )
