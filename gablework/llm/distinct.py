"""Texts told apart by their content, and a table of the distinct ones."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.sources.scratch import fresh_path


def text_key(text: Column) -> list[Column]:
    """Two hashes that tell texts apart; null and empty text are the same."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit("2"), whole).alias("k2")]


def distinct_texts(docs: DataFrame, text: str, key: str | None = None) -> str:
    """Write distinct texts with their number of copies (and least key) in buckets of ``(k1, k2)``.

    Copies are combined before the shuffle, so a text that fills a third of the rows costs one row per
    task. The buckets let later joins bring the small side to the texts. Returns the table's name.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    least = [] if key is None else [F.col(f"`{key}`").alias("key")]
    keyed = docs.select(*text_key(whole), whole.alias("text"), *least)
    sums = [F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")]
    distinct = keyed.groupBy("k1", "k2").agg(*sums, *([] if key is None else [F.min("key").alias("key")]))
    name = f"texts_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = distinct.write.option("path", fresh_path(spark, "texts")).option("compression", "zstd")
    writer.bucketBy(buckets, "k1", "k2").saveAsTable(name)
    return name
