"""Token ids as Parquet list columns, for selective reads of tokens and of metadata.

Documents are dealt by ranges of their key and sorted, so file and row order are key order.
Columns: the key, ``part`` (ordinal of the range), ``part_start`` (ids before the document within its part),
``n_tokens`` and ``ids``. Ids are dictionary-encoded, or delta-packed if asked for; row groups
and pages are small enough that page indexes let a reader fetch some documents' ids, or metadata alone.

Global starts come from the files: one sum per part, added up over the parts.

Defined cases: null text counts as empty and has the end id alone; null keys sort first;
equal keys are ordered by a hash of their text; other columns are not written; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gablework.llm.pretokens import Splitter, WordCache, byte_letters, load, text_batches, word_tokenizer


@dataclass(frozen=True)
class TokenLayout:
    encoding: str = "dictionary"  # or "delta"
    row_group_bytes: int = 16 << 20
    page_bytes: int = 64 << 10
    page_rows: int = 256
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"encoding: {self.encoding}")
        return {
            "compression": self.codec,
            "parquet.enable.dictionary": str(self.encoding == "dictionary").lower(),
            "parquet.writer.version": "PARQUET_2_0" if self.encoding == "delta" else "PARQUET_1_0",
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
        }


@lru_cache(maxsize=2)
def _cache(vocabulary: str) -> WordCache:
    """Ids of whole words from the tokenizers library; merges never cross words, so texts follow."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokens = load(vocabulary)
    in_letters = all(map(str.isascii, tokens.specials))  # bytes of ASCII are their own letters
    tokenizer = word_tokenizer(vocabulary, in_letters)
    letters = np.array([ord(" ") if b == 0x20 else ord(x) for b, x in enumerate(byte_letters())], "<u4")
    closing = np.zeros(max([*tokens.vocabulary.values(), *tokens.specials.values()]) + 1, bool)
    closing[[i for t, i in tokens.vocabulary.items() if t.endswith(tokens.suffix)]] = True
    closing[list(tokens.specials.values())] = True

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words set apart by blanks are encoded many at a time; the last id of each is one that closes a word."""
        runs = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
        if in_letters:
            runs = [letters[np.frombuffer(r.encode(), np.uint8)].tobytes().decode("utf-32-le") for r in runs]
        found = [e.ids for e in tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), np.int64)
        lengths = np.diff(np.flatnonzero(closing[flat]), prepend=-1)
        if len(lengths) != len(words):
            raise ValueError("the vocabulary does not mark where words end")
        return flat, lengths

    return WordCache(Splitter(vocabulary), encode, bound=400_000)


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    layout: TokenLayout = TokenLayout(),
) -> None:
    """Write the ids of every text, each closed by ``end_id``, in key order."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, part int, part_start bigint, n_tokens bigint, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        cache = _cache(vocabulary)
        for batch in batches:
            for first, texts in text_batches(batch, "_text", 2 << 20):
                flat, lengths = cache.ids(texts)
                flat = np.insert(flat, np.cumsum(lengths), end_id)
                lengths = lengths + 1
                ends = np.cumsum(lengths)
                rows = len(texts)
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(first, rows),
                        pa.array(np.full(rows, part, np.int32)),
                        pa.array(before + ends - lengths),
                        pa.array(lengths),
                        ids,
                    ],
                    [key, "part", "part_start", "n_tokens", "ids"],
                )
                before += int(ends[-1]) if rows else 0

    plain = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    order = ["_key", "_tie"]
    dealt = plain.withColumn("_tie", F.xxhash64("_text")).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("_key", "_text").mapInArrow(run, schema).write.options(**layout.options()).parquet(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part`` and the ids before it: one row per written part, read from metadata columns alone."""
    totals = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return totals.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("ids",), keys: tuple | None = None, key: str = "doc_id") -> DataFrame:
    """Key, ``start``, ``n_tokens`` and the columns asked for; ``keys=(low, high)`` reads that range only."""
    rows = spark.read.parquet(path)
    if keys is not None:
        rows = rows.filter(F.col(f"`{key}`").between(*keys))
    # One row per part, so as many as the writing job had tasks.
    starts = F.broadcast(part_starts(spark, path))
    placed = rows.join(starts, "part").withColumn("start", F.col("part_start") + F.col("_before"))
    return placed.select(f"`{key}`", "start", "n_tokens", *columns)


def checksums(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, start, number of ids, and the CRC of the ids as little-endian 32-bit integers."""
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            kept = [batch.column(c) for c in (key, "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], [key, "start", "n_tokens", "ids_crc32"])

    schema = f"`{key}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return tokens.select(f"`{key}`", "start", "n_tokens", "ids").mapInArrow(run, schema)
