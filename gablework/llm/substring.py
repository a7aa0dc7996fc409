"""Substring dedup: words in passages that occur elsewhere, by seed and extend.

Seeds are winnowed anchors: of the hashes of ``SEED``-word runs in every stretch as long as the
threshold, the least is kept. Two places with the same words for the threshold's length keep the
same anchor, so a passage whose anchor stands nowhere else is unique and is done with. Shared anchors are joined by value.

They are extended without pairing places. Where anchors follow one another, the stretch from one
to beyond the next is hashed as a whole; if that value occurs twice, everything in it repeats.
What is left, the ends of matches and stretches that differ, is extended window by window:
each threshold-long run of words around a shared anchor is hashed and counted (of a stretch that repeats, the
runs of one copy, for others to meet). So work is linear in
the text however often a passage occurs, and the result is exact: the words covered by a run of
``window`` words that also starts elsewhere.

Texts are first made distinct (a text of at least ``window`` words that occurs twice is removed whole), and
written in buckets of their key, so later joins bring the small side to them. Values are 128 bits.

Defined cases: null text counts as empty; texts shorter than the window lose nothing; repeated rows are copies of each other and are judged
alike; keys and further columns are never looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.llm.distinct import distinct_texts, text_key
from gablework.llm.pretokens import text_batches
from gablework.llm.words import BASE, SECOND, Words, least, split
from gablework.sources.scratch import materialize

SEED = 12


class Passages:
    """Anchors and windows of a batch of texts."""

    def __init__(self, texts: list[str], window: int):
        self.window = window
        self.raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.words: Words = split(self.raw)
        self.sums = (self.words.prefix(BASE), self.words.prefix(SECOND))
        n = len(self.words.hashes)
        self.n_windows = np.maximum(np.diff(self.words.first) - window + 1, 0)
        # Windows of all texts, end to end, by their first word.
        self.window_text = np.repeat(np.arange(len(texts)), self.n_windows)
        offset = np.concatenate([[0], np.cumsum(self.n_windows)])
        self.window_first = offset
        self.window_at = np.arange(offset[-1]) - np.repeat(offset[:-1] - self.words.first[:-1], self.n_windows)
        if len(self.window_at):
            seeds = self.words.runs(self.sums[0], BASE, np.arange(n - SEED + 1), np.full(n - SEED + 1, SEED))
            # The least seed of each window; windows never leave their text, so neither do these.
            self.seeds = seeds
            self.anchor = least(seeds, window - SEED + 1)[self.window_at]
        else:
            self.seeds = self.anchor = np.empty(0, np.uint64)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and value of every seed that is the least of some window, equal ones included.

        A seed is one if it equals the greatest anchor of the windows that contain it.
        """
        width = self.window - SEED + 1
        anchors = np.zeros(len(self.seeds) + width - 1, np.uint64)
        anchors[self.window_at + width - 1] = self.anchor
        greatest = ~least(~anchors, width) if len(self.seeds) else self.seeds
        at = np.flatnonzero((self.seeds == greatest) & (greatest > 0))
        return np.searchsorted(self.words.first, at, side="right") - 1, self.seeds[at].view(np.int64)

    def values(self, at: np.ndarray, length) -> tuple[np.ndarray, np.ndarray]:
        length = np.broadcast_to(np.asarray(length), at.shape)
        return (
            self.words.runs(self.sums[0], BASE, at, length).view(np.int64),
            self.words.runs(self.sums[1], SECOND, at, length).view(np.int64),
        )

    def covered(self, repeats: np.ndarray) -> np.ndarray:
        """Per word, whether a marked window covers it."""
        change = np.zeros(len(self.words.hashes) + 1, np.int32)
        at = self.window_at[repeats]
        np.add.at(change, at, 1)
        np.add.at(change, at + self.window, -1)
        return np.cumsum(change[:-1]) > 0


def _once(text: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each value within its text, and how often it occurs there."""
    order = np.lexsort((h2, h1, text))
    if not len(order):
        return order, np.empty(0, np.int64)
    new = np.ones(len(order), bool)
    t, a, b = text[order], h1[order], h2[order]
    new[1:] = (t[1:] != t[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    spots = np.flatnonzero(new)
    return order[spots], np.diff(np.append(spots, len(order)))


def _rows(batch: pa.RecordBatch, first: int, text: np.ndarray) -> list[pa.Array]:
    take = pa.array(text + first)
    return [batch.column("k1").take(take), batch.column("k2").take(take)]


VALUE_ROWS = "k1 bigint, k2 bigint, h1 bigint, h2 bigint, n int"


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, most=1 << 20):
                p = Passages(texts, window)
                text, value = p.places()
                zero = np.zeros(len(value), np.int64)
                spot, n = _once(text, value, zero)
                yield pa.RecordBatch.from_arrays(
                    [*_rows(batch, first, text[spot]), pa.array(value[spot]), pa.array(zero[spot]), pa.array(n.astype(np.int32))],
                    ["k1", "k2", "h1", "h2", "n"],
                )

    return run


def _stretches(p: Passages, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, with stretches that reach over the next run: first window, windows, words.

    A stretch covers all windows of its run; it exists if the run after it, in the same text, is shared too.
    """
    n = len(p.anchor)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    new = np.ones(n, bool)
    new[1:] = (p.anchor[1:] != p.anchor[:-1]) | (p.window_text[1:] != p.window_text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    same = np.zeros(len(first), bool)
    same[:-1] = p.window_text[first[1:]] == p.window_text[first[:-1]]
    follows = np.zeros(len(first), bool)
    follows[:-1] = shared[first[1:]]
    usable = shared[first] & same & follows
    return first[usable], count[usable], count[usable] - 1 + p.window


def _member(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    value = batch.column(column)[row]
    return np.array(value.as_py() or [], np.int64)


def _shared_windows(batch: pa.RecordBatch, first: int, p: Passages) -> np.ndarray:
    flags = np.zeros(len(p.anchor), bool)
    for i in range(len(p.n_windows)):
        a, b = p.window_first[i], p.window_first[i + 1]
        if b > a:
            wanted = _member(batch, "anchors", first + i)
            if len(wanted):
                flags[a:b] = np.isin(p.anchor[a:b].view(np.int64), wanted)
    return flags


def _stretch_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, most=1 << 20):
                p = Passages(texts, window)
                at, _, length = _stretches(p, _shared_windows(batch, first, p))
                h1, h2 = p.values(p.window_at[at], length)
                spot, n = _once(p.window_text[at], h1, h2)
                yield pa.RecordBatch.from_arrays(
                    [*_rows(batch, first, p.window_text[at][spot]), pa.array(h1[spot]), pa.array(h2[spot]), pa.array(n.astype(np.int32))],
                    ["k1", "k2", "h1", "h2", "n"],
                )

    return run


def _settled(batch: pa.RecordBatch, first: int, p: Passages, shared: np.ndarray, column: str = "stretches") -> np.ndarray:
    """Windows known to repeat from the stretches that do."""
    at, count, length = _stretches(p, shared)
    flags = np.zeros(len(p.anchor) + 1, np.int32)
    if len(at):
        h1, _ = p.values(p.window_at[at], length)
        text = p.window_text[at]
        hit = np.zeros(len(at), bool)
        for i in np.unique(text):
            own = np.flatnonzero(text == i) if len(p.n_windows) == 1 else np.arange(*np.searchsorted(text, [i, i + 1]))
            hit[own] = np.isin(h1[own], _member(batch, column, first + int(i)))
        np.add.at(flags, at[hit], 1)
        np.add.at(flags, at[hit] + count[hit], -1)
    return np.cumsum(flags[:-1]) > 0


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, most=1 << 20):
                p = Passages(texts, window)
                shared = _shared_windows(batch, first, p)
                settled = _settled(batch, first, p, shared) & ~_settled(batch, first, p, shared, "stretches_owned")
                left = np.flatnonzero(shared & ~settled)
                h1, h2 = p.values(p.window_at[left], window)
                spot, n = _once(p.window_text[left], h1, h2)
                yield pa.RecordBatch.from_arrays(
                    [*_rows(batch, first, p.window_text[left][spot]), pa.array(h1[spot]), pa.array(h2[spot]), pa.array(n.astype(np.int32))],
                    ["k1", "k2", "h1", "h2", "n"],
                )

    return run


RESULT = "k1 bigint, k2 bigint, n_words bigint, n_removed bigint, kept string, spans array<struct<start:int,end:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _result_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, most=1 << 20):
                p = Passages(texts, window)
                shared = _shared_windows(batch, first, p)
                repeats = _settled(batch, first, p, shared)
                copies = np.array(batch.column("copies").slice(first, len(texts)).to_pylist(), np.int64)
                for i in range(len(texts)):
                    a, b = p.window_first[i], p.window_first[i + 1]
                    if b > a and copies[i] > 1:
                        repeats[a:b] = True
                    elif b > a and len(wanted := _member(batch, "windows", first + i)):
                        left = np.arange(a, b)[shared[a:b] & ~repeats[a:b]]
                        repeats[left] |= np.isin(p.values(p.window_at[left], window)[0], wanted)
                gone = p.covered(repeats)
                words, removed, kept, spans = [], [], [], []
                for i, raw in enumerate(p.raw):
                    own = gone[p.words.first[i] : p.words.first[i + 1]]
                    parts = raw.split()
                    words.append(len(own))
                    removed.append(int(own.sum()))
                    kept.append(b" ".join([w for w, g in zip(parts, own) if not g] if removed[-1] else parts))
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("k1"), rows.column("k2"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, SPANS)],
                    ["k1", "k2", "n_words", "n_removed", "kept", "spans"],
                )

    return run


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    """Per text, the values (their first half) that occur twice or more over all texts.

    Counting combines before its shuffle; the join deals a frequent value's rows over several tasks where adaptive
    execution is on. A text's own values are many at most as its words. ``<name>_owned`` are those of
    which this text is the first: it speaks for them where each is needed once.
    """
    me = F.struct("k1", "k2")
    twice = rows.groupBy("h1", "h2").agg(F.sum("n").alias("_n"), F.min(me).alias("_owner")).filter("_n > 1")
    hits = rows.join(twice.select("h1", "h2", "_owner"), ["h1", "h2"])
    mine = F.when(F.col("_owner") == me, F.col("h1"))
    return hits.groupBy("k1", "k2").agg(F.collect_list("h1").alias(name), F.collect_list(mine).alias(f"{name}_owned"))


def repeated_passages(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """Per distinct text: key ``(k1, k2)``, words, removed words, the kept words joined, and removed word spans."""
    if window < SEED:
        raise ValueError(f"window: at least {SEED} words")
    spark = docs.sparkSession
    name = distinct_texts(docs, text)
    # Texts that occur twice are removed whole if long enough, but their passages still count for others.
    texts = spark.table(name)
    anchors = materialize(texts.select("k1", "k2", "text").mapInArrow(_anchor_rows(window), VALUE_ROWS), "anchors")
    seeded = materialize(_repeated(anchors, "anchors"), "seeded")
    base = spark.table(name).join(seeded, ["k1", "k2"])
    stretches = materialize(base.select("k1", "k2", "text", "anchors").mapInArrow(_stretch_rows(window), VALUE_ROWS), "stretches")
    long = materialize(_repeated(stretches, "stretches"), "long")
    grown = spark.table(name).join(seeded, ["k1", "k2"]).join(long, ["k1", "k2"], "left")
    windows = materialize(grown.select("k1", "k2", "text", "anchors", "stretches", "stretches_owned").mapInArrow(_window_rows(window), VALUE_ROWS), "windows")
    single = materialize(_repeated(windows, "windows"), "single")
    whole = spark.table(name).join(seeded, ["k1", "k2"], "left").join(long, ["k1", "k2"], "left").join(single, ["k1", "k2"], "left")
    return whole.select("k1", "k2", "text", "copies", "anchors", "stretches", "windows").mapInArrow(_result_rows(window), RESULT)


def dedup(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """The input with ``n_words``, ``n_removed``, ``kept`` and ``spans`` of its text."""
    found = repeated_passages(docs, window, text)
    # The row travels as one column, so no name of its columns can clash.
    mine = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "n_removed", "kept", "spans")]
    keyed = docs.select(F.struct(*mine).alias("row"), *text_key(F.col(f"`{text}`")))
    return keyed.join(found, ["k1", "k2"]).select("row.*", "n_words", "n_removed", "kept", "spans")


def digest(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, words, removed words and the digest of the kept words."""
    found = repeated_passages(docs, window, text).select("k1", "k2", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select(F.col(f"`{key}`"), *text_key(F.col(f"`{text}`")))
    return rows.join(found, ["k1", "k2"]).select(f"`{key}`", "n_words", "n_removed", "kept_sha256")
