"""Spelling variants: words one edit apart, grouped under their most frequent form.

``count_words`` counts the words of all texts, combined per task before the shuffle. ``variants`` looks for pairs of
words that differ by one inserted, deleted or replaced code point. Such words have letter counts at a squared distance
of one (lengths differ by one) or two (equal lengths). Words of two adjacent lengths meet in blocks; the product of a
block's count matrix with itself gives all squared distances in it, pairs at most two apart are kept, and
their spellings compared.

A block per length alone would grow with the square of the vocabulary, so blocks are cut further, without loss: letters
fall into four sets, an edit changes the counts of at most two of them, so the words of a pair agree on two sets
at least. Each pair of sets and their counts is a block key, and a pair of words is reported by
its first common key only. Keys with more than ``BLOCK_ROWS`` rows are cut into tiles, and every
pair of tiles is a block of its own.

Defined cases: null and empty texts have no words; a null key counts as empty text before the colon; long
texts are read whole; repeated rows count each; equal frequencies are settled by code-point order;
other columns are not read; an empty table has no words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.sources.scratch import materialize

WORD = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
# A run is spoiled when its hash is divisible by this.
SPOILED_OF = 199
BLOCK_ROWS = 1_024
# Hot keys are few; past this many they are joined by key instead.
BROADCAST_KEYS = 50_000
_TASK_WORDS = 300_000

# Letters by how common they are, so that dealing them in turn makes four sets of about equal weight.
_BY_USE = "etaoinshrdlucmfwypvbgkjqxz"
ALPHABET = _BY_USE + "".join(map(chr, range(0xC0, 0x100)))
SETS = 4
SET_PAIRS = [(a, b) for a in range(SETS) for b in range(a + 1, SETS)]
_COLUMN = np.full(0x100, len(ALPHABET), np.int64)  # the last column takes all other characters
_COLUMN[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
WIDTH = len(ALPHABET) + 1
_SET_OF = np.arange(WIDTH) % SETS


def spoil(run: str, doc: str) -> str:
    """The run, less one code point if its hash with the document says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % SPOILED_OF:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n`` over all texts: runs of letters, A-Z lower-cased, some spoiled by ``spoil``."""
    # A run of the least length or more is matched whole: the search moves on from where a run ends.
    find = re.compile(WORD.replace("A-Z", "") + f"{{{least_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for doc, whole in zip(batch.column("_key"), batch.column("_text")):
                counts = Counter(find(whole.as_py().encode().lower().decode()))
                doc_key = doc.as_py()
                start = zlib.crc32(f"{doc_key}:".encode())
                for word, n in counts.items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % SPOILED_OF:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    seen[word] = seen.get(word, 0) + n
            if len(seen) > _TASK_WORDS:
                yield _counted(seen)
                seen = {}
        if seen:
            yield _counted(seen)

    def _counted(seen: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(seen.values(), pa.int64())], ["word", "n"])

    plain = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"), F.coalesce(f"`{text}`", F.lit("")).alias("_text")
    )
    return plain.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each letter of the alphabet (last: any other) stands in each word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    columns = _COLUMN[np.where(codes < 0x100, codes, 0)]
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    return np.bincount(owner * WIDTH + columns, minlength=len(words) * WIDTH).reshape(-1, WIDTH)


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and a != b and a[at + (len(a) == len(b)) :] == b[at + 1 :]


_SALT = np.random.default_rng(11).integers(1, 1 << 63, (len(SET_PAIRS), WIDTH + 1), dtype=np.uint64) | np.uint64(1)


def _block_rows(words: DataFrame) -> DataFrame:
    """``key, slot, longer, word, n``: each word under its own length and, as a longer partner, under one less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            if not found:
                continue
            counts = letter_counts(found).astype(np.uint64)
            length = counts.sum(axis=1)
            for slot, pair in enumerate(SET_PAIRS):
                kept = np.isin(_SET_OF, pair)
                base = (counts[:, kept] * _SALT[slot, :-1][kept]).sum(axis=1, dtype=np.uint64)
                for longer in (False, True):
                    key = base + (length - np.uint64(longer)) * _SALT[slot, -1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            pa.array(np.full(len(found), slot, np.int8)),
                            pa.array(np.full(len(found), longer)),
                            batch.column("word"),
                            batch.column("n"),
                        ],
                        ["key", "slot", "longer", "word", "n"],
                    )

    return words.mapInArrow(run, "key bigint, slot tinyint, longer boolean, word string, n bigint")


def _tiled(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows with the two tiles whose pairs they belong to; 0 and 0 unless a key is hot."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > block_rows)
    hot = materialize(sizes.select("key", F.ceil(F.col("rows") / block_rows).cast("int").alias("tiles")), "spelling_hot")
    few = hot.count() <= BROADCAST_KEYS
    joined = rows.join(F.broadcast(hot) if few else hot, "key", "left")
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("word"), tiles).cast("int")
    spread = joined.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), tiles - 1))})
    return spread.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "tiles")


def near_pairs(words: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word, near, near_n``: every pair of words one edit apart, once in each direction."""
    rows = _tiled(materialize(_block_rows(words), "spelling_blocks"), block_rows)
    block = ["key", "slot", "low", "high"]
    # In a block of two different tiles, pairs within one of them are another block's.
    dealt = rows.select(*block, "longer", "own", "word", "n").repartition(*block).sortWithinPartitions(*block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _starts(batch, block)
            if held and (len(starts) > 1 or _row(held[-1], block, -1) != _row(batch, block, 0)):
                # The first rows may go on with what is held; all that is whole is done.
                same = _row(held[-1], block, -1) == _row(batch, block, 0)
                first = (int(starts[1]) if len(starts) > 1 else batch.num_rows) if same else 0
                yield from _pairs(pa.Table.from_batches([*held, batch.slice(0, first)]), block)
                held, batch = [], batch.slice(first)
                starts = starts[starts >= first] - first
            if batch.num_rows and len(starts) > 1:
                last = int(starts[-1])
                yield from _pairs(pa.Table.from_batches([batch.slice(0, last)]), block)
                batch = batch.slice(last)
            if batch.num_rows:
                held.append(batch)
        if held:
            yield from _pairs(pa.Table.from_batches(held), block)

    return dealt.mapInArrow(run, "word string, near string, near_n bigint")


def _row(batch, names: list[str], at: int) -> tuple:
    at = at % batch.num_rows
    return tuple(batch.column(n)[at].as_py() for n in names)


def _starts(table, names: list[str]) -> np.ndarray:
    """Where a new block begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in names:
        column = table.column(name).to_numpy() if isinstance(table, pa.Table) else table.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


# Floats of one batch of products.
_PRODUCT_CELLS = 4_000_000


def _pairs(table: pa.Table, block: list[str]) -> Iterator[pa.RecordBatch]:
    """Pairs within each whole block of the table."""
    starts = _starts(table, block)
    sizes = np.diff(np.append(starts, table.num_rows))
    words = table.column("word").to_pylist()
    n = table.column("n").to_numpy()
    longer, own, slot = (table.column(c).to_numpy() for c in ("longer", "own", "slot"))
    split = table.column("low").to_numpy() != table.column("high").to_numpy()
    counts = letter_counts(words).astype(np.float32)
    square = (counts * counts).sum(axis=1)
    for size in np.unique(sizes[sizes > 1]):
        members = starts[sizes == size][:, None] + np.arange(size)
        at_once = max(1, _PRODUCT_CELLS // int(size * max(size, WIDTH)))
        for k in range(0, len(members), at_once):
            rows = members[k : k + at_once]
            stacked = counts[rows]
            product = stacked @ stacked.transpose(0, 2, 1)
            apart = square[rows][:, :, None] + square[rows][:, None, :] - 2 * product
            group, i, j = np.nonzero(np.triu(apart <= 2, 1))
            a, b = rows[group, i], rows[group, j]
            keep = ~(longer[a] & longer[b]) & ~(split[a] & (own[a] == own[b])) & (apart[group, i, j] > 0)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            changed = np.abs(counts[a] - counts[b])
            agree = np.stack([changed[:, _SET_OF == s].sum(axis=1) == 0 for s in range(SETS)], axis=1)
            common = np.stack([agree[:, x] & agree[:, y] for x, y in SET_PAIRS], axis=1)
            first = common.any(axis=1) & (common.argmax(axis=1) == slot[a])
            found = [(x, y) for x, y in zip(a[first].tolist(), b[first].tolist()) if one_edit(words[x], words[y])]
            if found:
                x, y = np.array(found).T
                left, right = np.concatenate([x, y]), np.concatenate([y, x])
                arrays = [pa.array([words[v] for v in left]), pa.array([words[v] for v in right]), pa.array(n[right])]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "near", "near_n"])


def variants(counted: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words with ``least_count`` occurrences or more.

    A word's form is its most frequent near word, if that is ``times`` as frequent; its root is where
    forms lead. Each step multiplies the count, so the counts bound how many steps there can be.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could lead in circles")
    words = materialize(counted.filter(F.col("n") >= least_count), "spelling_words")
    best = (
        near_pairs(words, block_rows)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    often = -F.col("best.less")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(often >= times * F.col("n"), F.col("best.near")).alias("form"),
        F.when(often >= times * F.col("n"), often).alias("form_n"),
    )
    formed = materialize(formed, "spelling_forms")
    most = formed.agg(F.max("form_n")).first()[0]
    step = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    steps = 0 if most is None else math.ceil(math.log(max(most / least_count, times), times) + 1e-9) + 1
    reach = 1
    while reach < steps:  # each round doubles how far roots lie
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")
        reach *= 2
    return formed.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
