"""BPE encoding and decoding by batched merge rounds.

The distinct words of a batch lie in one flat symbol array. A round looks up every pair of
neighbours at once, by binary search in the sorted keys of the mergeable pairs; in each word
the pair of lowest rank is merged wherever it stands, and the array is packed. Rounds end when no word
has a mergeable pair. A word leaves the array as soon as it is done.

A very long word has thousands of rounds, each of which merges little of it. Such a word is taken alone: places
are kept by the rank of their pair, and a round looks up only the pairs beside its merges.

Word results are kept per Python worker, so each distinct word is merged about once.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.llm.pretokens import Splitter, Tokens, WordCache, byte_letters, load, text_batches

NO_PAIR = np.iinfo(np.int64).max
LONG_WORD = 4_000  # symbols above which a word's rounds are its own


class MergeTable:
    """The merges of a vocabulary as arrays: sorted pair keys, their ranks, what they make."""

    def __init__(self, tokens: Tokens):
        vocabulary = tokens.vocabulary
        keys = [vocabulary[a] << 32 | vocabulary[b] for a, b in tokens.merges]
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in tokens.merges], np.int64)[order]
        letters = byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int64)
        self.last = np.array([vocabulary[x + tokens.suffix] for x in letters], np.int64)
        self.specials = tokens.specials
        self.tokens: list[str] = [""] * (max([*vocabulary.values(), *tokens.specials.values()]) + 1)
        for token, i in (*vocabulary.items(), *tokens.specials.items()):
            self.tokens[i] = token

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, end to end, and how many each has."""
        raw = [b"" if w in self.specials else w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        bytes_ = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[bytes_]
        ends = np.cumsum(lengths)
        solid = lengths > 0
        symbols[ends[solid] - 1] = self.last[bytes_[ends[solid] - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        for i in np.flatnonzero(lengths > LONG_WORD):
            done_symbols.append(self._merge_alone(symbols[ends[i] - lengths[i] : ends[i]]))
            done_words.append(np.full(len(done_symbols[-1]), i))
        if done_words:
            short = lengths[word] <= LONG_WORD
            symbols, word = symbols[short], word[short]
        while len(symbols):
            rank, spot = self._pairs(symbols, word)
            firsts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.r_[firsts, len(word)])
            wanted = np.repeat(lowest, sizes)
            open_ = wanted != NO_PAIR
            done_symbols.append(symbols[~open_])
            done_words.append(word[~open_])
            merge = self._leftmost((rank == wanted) & open_)
            symbols = np.where(merge, self.made[spot], symbols)
            stay = open_ & ~np.r_[False, merge[:-1]]
            symbols, word = symbols[stay], word[stay]
        flat = np.concatenate(done_symbols) if done_symbols else np.empty(0, np.int64)
        owner = np.concatenate(done_words) if done_words else np.empty(0, np.int64)
        special = [(i, self.specials[w]) for i, w in enumerate(words) if w in self.specials]
        if special:
            owner = np.r_[owner, [i for i, _ in special]].astype(np.int64)
            flat = np.r_[flat, [x for _, x in special]].astype(np.int64)
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(words))

    def _merge_alone(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of one word; a round costs what it merges."""
        n = len(symbols)
        symbols = np.r_[symbols, -1]  # place n: the end
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        rank, spot = np.full(n + 1, NO_PAIR), np.zeros(n + 1, np.int64)
        places: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def look_up(at: np.ndarray) -> None:
            right = symbols[after[at]]
            key = symbols[at] << 32 | right
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (right >= 0) & (self.keys[place] == key)
            rank[at] = np.where(found, self.ranks[place], NO_PAIR)
            spot[at] = place
            at = at[found]
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            firsts = np.flatnonzero(np.diff(rank[at], prepend=-1))
            for own in np.split(at, firsts[1:]) if len(at) else []:
                r = int(rank[own[0]])
                if r not in places:
                    heapq.heappush(ranks, r)
                places.setdefault(r, []).append(own)

        look_up(np.arange(n))
        while ranks:
            lowest = heapq.heappop(ranks)
            at = np.unique(np.concatenate(places.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            # Of overlapping pairs (aaa), every second one from the left.
            chained = np.r_[False, after[at[:-1]] == at[1:]]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            gone = after[at]
            symbols[at] = self.made[spot[at]]
            rank[gone] = NO_PAIR
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            look_up(np.unique(np.r_[at, left[left >= 0]]))
        alive = []
        at = 0
        while at < n:
            alive.append(at)
            at = int(after[at])
        return symbols[alive]

    def _pairs(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that starts at each symbol, and its place in the table."""
        rank = np.full(len(symbols), NO_PAIR)
        spot = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][found] = self.ranks[at[found]]
            spot[:-1] = at
        return rank, spot

    @staticmethod
    def _leftmost(merge: np.ndarray) -> np.ndarray:
        """Of overlapping pairs (aaa), every second one from the left."""
        first = merge & ~np.r_[False, merge[:-1]]
        if first.sum() == merge.sum():
            return merge
        place = np.arange(len(merge))
        run = np.maximum.accumulate(np.where(first, place, 0))
        return merge & ((place - run) % 2 == 0)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks: the file names no decoder. Ids outside the vocabulary are skipped."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if 0 <= i < len(tokens) and tokens[i]])


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(load(path))


@lru_cache(maxsize=2)
def _cache(path: str) -> WordCache:
    return WordCache(Splitter(path), merge_table(path).encode_words)


def encode_texts(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and the number of ids per text."""
    return _cache(path).ids(texts)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", into: str = "ids") -> DataFrame:
    """The input with a column of token ids (``array<int>``).

    Null and empty texts give an empty list. A column of the same name is replaced; all others pass through.
    """
    schema = docs.drop(into).withColumn(into, F.array().cast("array<int>")).schema
    kept = [c for c in docs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, text):
                flat, lengths = encode_texts(vocabulary, texts)
                offsets = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], ids], [*kept, into])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The input with the text of its ids; null ids give null."""
    schema = docs.drop(into).withColumn(into, F.lit("x")).schema
    kept = [c for c in docs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                found = [None if x is None else table.decode(x) for x in rows.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], pa.array(found, pa.string())], [*kept, into])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def digest(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, number of ids, digests of the ids and of the decoded text, in one pass.

    Nothing larger than the digests leaves the Python worker.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary)
        for batch in batches:
            for first, texts in text_batches(batch, text):
                flat, lengths = encode_texts(vocabulary, texts)
                little = flat.astype("<u4")
                ends = np.cumsum(lengths)
                ids_sha, text_sha = [], []
                for start, end in zip(ends - lengths, ends):
                    own = little[start:end]
                    ids_sha.append(hashlib.sha256(own.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(table.decode(own.tolist()).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(first, len(texts)), pa.array(lengths, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(run, schema)
