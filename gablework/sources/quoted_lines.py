"""Records of delimited files whose quoted values hold line breaks, read in splits.

Spark reads such files one task to a file. Here the files are scanned as lines, in splits as any text, and lines are
put together to records in three steps:

1. Each line says what it does to the quote state, whichever it starts in: keep it, swap it, or
   end outside or inside quotes in any case. Lines that keep it, nearly all, are dropped; the others are folded to
   one such effect per split. What reaches the driver is one row per split that does not keep the state.
2. A prefix over the splits of each file gives the state every split starts in.
3. Lines are scanned again, and each task joins those of its splits. Records that lie in one split, nearly
   all, are done. Pieces of the records that cross a border, at most two rows per split, are grouped and joined.

Rows are neither shuffled nor kept, and a lost task is repeated from its split alone. Quotes open a value only at its
start, are doubled inside, and are plain characters in a value without quotes, as in Spark's own reader. Records end
with a line feed, before which a carriage return is dropped; breaks in quotes stay as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a line does to the state: 0 outside, 1 inside quotes.
KEEP, SWAP, OUTSIDE, INSIDE = range(4)
# States within a line: at the start of a value, in one without quotes, in quotes, after a quote in quotes.
_START, _PLAIN, _QUOTED, _CLOSED = range(4)


def _end_state(line: Column, sep: str, first: int) -> Column:
    """The state at the end of a line that starts in ``first``, one step for each text between quotes."""

    def after_text(state: Column, text: Column) -> Column:
        moved = F.when(F.endswith(text, F.lit(sep)), _START).otherwise(_PLAIN)
        return F.when((text == "") | (state == _QUOTED), state).otherwise(moved)

    def step(state: Column, text: Column) -> Column:
        quote = (
            F.when(state == _START, _QUOTED)
            .when(state == _QUOTED, _CLOSED)
            .when(state == _CLOSED, _QUOTED)
            .otherwise(_PLAIN)
        )
        return after_text(quote, text)

    texts = F.split(line, '"', -1)
    rest = F.slice(texts, F.lit(2), F.size(texts) - 1)
    return F.aggregate(rest, after_text(F.lit(first), texts[0]), step)


def effect(line: Column, sep: str) -> Column:
    outside, inside = _end_state(line, sep, _START) == _QUOTED, _end_state(line, sep, _QUOTED) == _QUOTED
    known = (
        F.when(~outside & inside, KEEP).when(outside & ~inside, SWAP).when(outside & inside, INSIDE).otherwise(OUTSIDE)
    )
    return F.when(F.instr(line, '"') == 0, KEEP).otherwise(known)


def _after(state: int, what: int) -> int:
    return (state, 1 - state, 0, 1)[what]


def quoted_lines(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """Every line with its file, the start of its split, its place in the task, and its effect."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
        effect(F.col("value"), sep).cast("tinyint").alias("effect"),
    )


def split_effects(lines: DataFrame) -> DataFrame:
    """``file, split, effect`` of the splits that do not keep the state.

    The last line that fixes the state settles it, but for the swaps after it.
    """
    turning = lines.filter(F.col("effect") != KEEP).select("file", "split", "place", "effect")
    within = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = turning.withColumn("swaps", F.sum((F.col("effect") == SWAP).cast("int")).over(within))
    fixing = F.when(F.col("effect") >= OUTSIDE, F.struct("place", (F.col("effect") - OUTSIDE).alias("state"), "swaps"))
    folded = counted.groupBy("file", "split").agg(F.max("swaps").alias("swaps"), F.max(fixing).alias("last"))
    odd = (F.col("swaps") - F.coalesce("last.swaps", F.lit(0))) % 2
    what = F.when(F.col("last").isNull(), odd).otherwise(OUTSIDE + (F.col("last.state") + odd) % 2)
    return folded.select("file", "split", what.cast("tinyint").alias("effect")).filter(F.col("effect") != KEEP)


def start_states(effects: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """For each file, the splits that change the state, and the state after each."""
    found: dict[str, tuple[list[int], list[int]]] = {}
    rows = effects.collect()  # at most one row per split
    for row in sorted(rows, key=lambda r: (r["file"], r["split"])):
        splits, states = found.setdefault(row["file"], ([], []))
        states.append(_after(states[-1] if states else 0, row["effect"]))
        splits.append(row["split"])
    return found


# Parts of a record: all of it, or its first, a middle or its last piece; the record with the names is left out.
WHOLE, FIRST, MIDDLE, LAST, NAMES = range(5)


def _joined(states: dict[str, tuple[list[int], list[int]]], wanted: tuple[int, ...]):
    """A task's lines to ``file, split, part, record`` for the wanted parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, part = None, 0, [], WHOLE
        out: list[tuple] = []
        size = 0

        def add(kind: int, record: str) -> None:
            nonlocal size
            if kind in wanted:
                out.append((*at, kind, record))
                size += len(record)

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            columns = list(zip(*out)) if out else [[]] * 4
            types = (pa.string(), pa.int64(), pa.int8(), pa.string())
            rows, out, size = [pa.array(c, t) for c, t in zip(columns, types)], [], 0
            return pa.RecordBatch.from_arrays(rows, ["file", "split", "part", "record"])

        def leave() -> None:
            if held:
                add(MIDDLE if part == LAST else NAMES if part == NAMES else FIRST, "\n".join(held))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("file", "split", "line", "effect")]
            for file, split, line, what in zip(*columns):
                if at != (file, split):
                    if at is not None:
                        leave()
                    at, held = (file, split), []
                    splits, after = states.get(file, ((), ()))
                    k = bisect_left(splits, split)
                    state = after[k - 1] if k else 0
                    part = LAST if state else NAMES if split == 0 else WHOLE
                ended = (state, 1 - state, 0, 1)[what] == 0
                state = 0 if ended else 1
                if not ended:
                    held.append(line)
                    continue
                record = "\n".join([*held, line]) if held else line
                if part == LAST or record not in ("", "\r"):
                    if part != NAMES:
                        add(part, record)
                    part = WHOLE
                held = []
            if size > 1 << 20 or len(out) >= 10_000:
                yield flush()
        if at is not None:
            leave()
        if out:
            yield flush()

    return run


_SCHEMA = "file string, split bigint, part tinyint, record string"


def records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """One column ``record``: every record of the files but each file's first, line breaks in quotes kept."""
    lines = quoted_lines(spark, path, sep)
    states = start_states(split_effects(lines))
    lines = lines.drop("place")
    whole = lines.mapInArrow(_joined(states, (WHOLE,)), _SCHEMA)
    crossing = lines.mapInArrow(_joined(states, (FIRST, MIDDLE, LAST, NAMES)), _SCHEMA)
    # In a split, the last piece of one record comes before the first of the next.
    later = F.when(F.col("part").isin(LAST, MIDDLE), 0).otherwise(1)
    in_order = Window.partitionBy("file").orderBy("split", later).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = crossing.withColumns({"later": later, "number": F.sum(later).over(in_order)})
    pieces = numbered.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("split", "later", "part", "record"))).alias("pieces")
    )
    kept = pieces.filter(F.col("pieces")[0]["part"] != NAMES)
    joined = kept.select(F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"))
    return whole.select("record").unionByName(joined).select(F.regexp_replace("record", "\r\\z", "").alias("record"))
