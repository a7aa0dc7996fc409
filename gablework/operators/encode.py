"""Categories to whole-number codes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gablework.functions.missing import is_missing, present, quoted
from gablework.functions.ordering import number_rows
from gablework.sources.scratch import materialize

# A lookup is collected and broadcast only within both bounds: at most 8 MB of names.
BROADCAST_ROWS = 20_000
LONGEST_NAME = 400  # bytes
# With a larger lookup, a category with more than one row in so many is hot.
HOT_SHARE = 1_000


def encode_mapping(
    df: DataFrame,
    column: str,
    mapping: Mapping[Any, int],
    output: str | None = None,
    on_unmapped: str | int = "null",
) -> DataFrame:
    """Replace categories, of the column's own type, by the codes of a written-out mapping.

    ``on_unmapped``: ``"null"``, ``"error"``, or a default code. A missing category
    stays missing.
    """
    pairs = list(mapping.items())
    kind = StructField("category", df.schema[column].dataType)
    lookup = df.sparkSession.createDataFrame(pairs, StructType([kind, StructField("code", IntegerType())]))
    small = len(pairs) <= BROADCAST_ROWS and all(len(str(k).encode()) <= LONGEST_NAME for k in mapping)
    if not small:
        return _look_up_large(df, column, lookup, output or column, on_unmapped)
    return _look_up(df, column, F.broadcast(lookup), output or column, on_unmapped)


@dataclass(frozen=True)
class TargetOrder:
    """Codes 1..n of the categories, ordered by mean target and then by name."""

    column: str
    table: DataFrame
    small: bool

    def apply(self, df: DataFrame, output: str | None = None, on_unmapped: str | int = "null") -> DataFrame:
        lookup = self.table.select("category", "code")
        if not self.small:
            return _look_up_large(df, self.column, lookup, output or self.column, on_unmapped)
        return _look_up(df, self.column, F.broadcast(lookup), output or self.column, on_unmapped)


def fit_target_order(df: DataFrame, column: str, target: str, most_broadcast: int | None = None) -> TargetOrder:
    """Rank the categories of ``column`` by their mean ``target``.

    The means are partial aggregates. A ranking that measures small is held as a local
    table and broadcast; a larger one stays distributed, is numbered block-wise, and is
    joined by key.
    """
    means = (
        df.filter(~is_missing(df, column))
        .groupBy(F.col(quoted(column)).alias("category"))
        .agg(F.avg(present(df, target)).alias("mean_target"))
    )
    spark: SparkSession = df.sparkSession
    head = _bounded_rows(means, BROADCAST_ROWS if most_broadcast is None else most_broadcast)
    if head is not None:
        head.sort(key=lambda r: (r["mean_target"] is None, r["mean_target"] or 0.0, r["category"]))
        schema = StructType([*means.schema.fields, StructField("code", IntegerType())])
        ranked = [(*row, place) for place, row in enumerate(head, start=1)]
        return TargetOrder(column, spark.createDataFrame(ranked, schema), True)
    # A category whose target is never known sorts last, as in the small case, and codes are of the same type.
    ordered = means.withColumns(
        {"_unknown": F.col("mean_target").isNull(), "_mean": F.coalesce("mean_target", F.lit(0.0))}
    )
    numbered = number_rows(ordered, ["_unknown", "_mean", "category"], "code").withColumn("code", F.col("code").cast("int"))
    return TargetOrder(column, numbered.drop("_unknown", "_mean"), False)


def _bounded_rows(means: DataFrame, most: int) -> list | None:
    """The rows, or None if there are too many or a name is too long to hold them."""
    size = F.octet_length(F.col("category").cast("string"))
    name = F.when(size <= LONGEST_NAME, F.col("category")).alias("category")
    rows = means.select(name, "mean_target").limit(most + 1).collect()
    if len(rows) > most or any(r["category"] is None for r in rows):
        return None
    return rows


def _look_up(df: DataFrame, column: str, lookup: DataFrame, output: str, on_unmapped: str | int) -> DataFrame:
    taken = {c.lower() for c in df.columns}
    category, code_name = (_free(n, taken) for n in ("_category", "_code"))
    named = lookup.withColumnsRenamed({"category": category, "code": code_name})
    code = _or_else(F.col(code_name), F.col(quoted(column)), on_unmapped).alias(output)
    joined = df.join(named, F.col(quoted(column)) == F.col(category), "left")
    if output in df.columns:
        return joined.select(*[code if c == output else F.col(quoted(c)) for c in df.columns])
    return joined.select(*map(quoted, df.columns), code)


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def _look_up_large(df: DataFrame, column: str, lookup: DataFrame, output: str, on_unmapped: str | int) -> DataFrame:
    """A lookup too large to broadcast, without a hot key.

    Categories that hold more than one row in ``HOT_SHARE`` are fewer than that, whatever the rows, and are
    looked up from a broadcast; so are missing ones, which no lookup holds. The others meet the lookup
    by key. Counting costs one pass over the column, combined before its shuffle.
    """
    key = F.col(quoted(column))
    counts = materialize(df.filter(key.isNotNull()).groupBy(key.alias("category")).count(), "categories")
    rows = counts.agg(F.sum("count")).first()[0] or 0
    short = F.octet_length(F.col("category").cast("string")) <= LONGEST_NAME
    hot = counts.filter((F.col("count") * HOT_SHARE > rows) & short).select("category")
    hot_lookup = F.broadcast(hot.join(lookup, "category", "left"))
    hot_key = _free("_hot", {c.lower() for c in df.columns})
    marked = df.join(F.broadcast(hot.withColumnRenamed("category", hot_key)), key == F.col(hot_key), "left")
    often = F.col(hot_key).isNotNull() | key.isNull()
    few = _look_up(marked.filter(often).drop(hot_key), column, hot_lookup, output, on_unmapped)
    # Without the hint a lookup that Spark takes for small would be broadcast after all.
    many = _look_up(marked.filter(~often).drop(hot_key), column, lookup.hint("merge"), output, on_unmapped)
    return few.unionByName(many)


def _or_else(code: Column, category: Column, on_unmapped: str | int) -> Column:
    if on_unmapped == "null":
        return code
    unmapped = code.isNull() & category.isNotNull()
    if on_unmapped == "error":
        complaint = F.raise_error(F.concat(F.lit("category without a code: "), category.cast("string")))
        return F.when(unmapped, complaint.cast("int")).otherwise(code)
    return F.when(unmapped, F.lit(int(on_unmapped))).otherwise(code)
