"""Cross-tokenizer alignment: byte-level BPE against piece BPE with byte fallback, over the bytes of each text.

``align`` encodes a blank and the text both ways and aligns the tokens of a batch of documents: ``merge_asof``, keyed
by document, gives for each token's start the other side's token that covers it; both directions together are all
overlaps, and overlapping tokens with equal ends close a group. ``link_rows`` turns groups into each document's
distinct id pairs with how often they occur and a digest; ``corpus_scores`` counts for each pair the documents that
hold it and scores every document's links by these counts.

Neither vocabulary has an entry that goes on from other characters into a blank, tab or line feed (checked on load), so merges never cross
such a border, and pieces between borders are encoded once per worker and looked up after that.

Counting is plain aggregation. Of the counted pairs, those in most documents are broadcast, never more than
``FREQUENT_PAIRS``; the other links meet their counts by a shuffle on the pair. That shuffle has no hot key: were
more than that many pairs as frequent as one of them, their links would exceed its own that many times.

Defined cases: null and empty texts, and texts that one side does not give back byte by byte (such as any with
U+2581), have no tokens, empty groups and zeros; special tokens' strings are plain text; long texts are aligned whole, one
at a time; repeated rows and equal or null keys are kept, each row a document; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from gablework.llm.pretokens import byte_letters, text_batches
from gablework.sources.scratch import materialize

FREQUENT_PAIRS = 1 << 18
# A pair is one whole number: the first id times this, plus the second.
SECOND_IDS = 1 << 20
# From one of these characters after one that is no white space, a piece begins.
_PIECE = re.compile(r"[ \t\n]\s*\S*(?:[^\S \t\n]\s*\S*)*")
_CROSSING = re.compile(r"[^\s▁][▁ \t\n]")
_MOST_PIECES, _MOST_IDS, _AT_ONCE = 150_000, 2_000_000, 1_000
# Characters aligned and tokens linked at once, beyond one text of any length.
_MOST_TEXT, _MOST_TOKENS = 1 << 18, 1 << 18
# Groups with more pairs than this are counted by their distinct ids first.
_LARGE_GROUP = 4_096


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts``, end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Side:
    """Ids of numbered pieces, in one flat array."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes  # bytes of each id
        self.clear()

    def clear(self) -> None:
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def append(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.new.append((ids, lengths))

    def close(self) -> None:
        """Take in what was appended."""
        flats, lengths = zip(*self.new)
        self.flat = np.concatenate([self.flat, *flats])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(lengths))])
        self.new = []

    def of(self, pieces: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of documents that are ``counts`` pieces each, and how many ids each has."""
        lengths = np.diff(self.starts)[pieces]
        borders = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[_spread(self.starts[pieces], lengths)], np.diff(borders[np.concatenate([[0], np.cumsum(counts)])])


class Encoders(dict):
    """Both tokenizers, and the numbers of pieces seen so far."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_bpe)
        self.first.encode_special_tokens = True
        self.first.no_truncation()
        self.first.no_padding()
        letters = {x: bytes([b]) for b, x in enumerate(byte_letters())}
        tokens = {i: t for t, i in self.first.get_vocab(with_added_tokens=False).items()}
        self.first_bytes = [b"".join(letters[x] for x in tokens.get(i, "")) for i in range(max(tokens) + 1)]
        self.second = SentencePieceProcessor(model_file=piece_bpe)
        ids = range(self.second.get_piece_size())
        pieces = list(map(self.second.id_to_piece, ids))
        fallback = list(map(self.second.is_byte, ids))
        self.second_bytes = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, fallback)]
        whole = [p for p, b in zip(pieces, fallback) if not b] + [b.decode(errors="replace") for b in self.first_bytes]
        if any(map(_CROSSING.search, whole)) or len(pieces) > SECOND_IDS:
            raise ValueError("a vocabulary has entries that go on into a blank, or too many")
        self.lead = self.second.piece_to_id("▁a")
        self.a = _Side(np.array(list(map(len, self.first_bytes))))
        self.b = _Side(np.array(list(map(len, self.second_bytes))))
        self.sound = [np.empty(0, bool)]
        self.pending: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.pending.append(piece)
        return number

    def _learn(self) -> None:
        """Ids of the new pieces. Pieces end to end are encoded as each alone, since merges cross no border."""
        new, self.pending = self.pending, []
        for k in range(0, len(new), _AT_ONCE):
            some = new[k : k + _AT_ONCE]
            # Only the last piece of a text ends in white space; such a piece would join the next.
            if any(p[-1].isspace() for p in some) or not self._learn_joined(some):
                for piece in some:
                    self._learn_one(piece)

    def _encode(self, pieces: str) -> tuple[list[int], list[int]]:
        # After a letter, whose own token is then the first, a piece is encoded as inside a text.
        led = self.second.encode("a" + pieces, num_threads=1)
        if led[0] != self.lead:
            raise ValueError("a piece joined the letter before it")
        return self.first.encode_batch_fast([pieces], add_special_tokens=False)[0].ids, led[1:]

    def _learn_joined(self, pieces: list[str]) -> bool:
        raws = [p.encode() for p in pieces]
        whole = b"".join(raws)
        borders = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        cut = []
        for side, ids, known in zip((self.a, self.b), self._encode("".join(pieces)), (self.first_bytes, self.second_bytes)):
            if b"".join(map(known.__getitem__, ids)) != whole:
                return False
            flat = np.array(ids, np.int32)
            ends = np.searchsorted(np.cumsum(side.sizes[flat]), borders, "right")
            cut.append((flat, np.diff(ends, prepend=0)))
        for side, (flat, lengths) in zip((self.a, self.b), cut):
            side.append(flat, lengths)
        self.sound.append(np.ones(len(pieces), bool))
        return True

    def _learn_one(self, piece: str) -> None:
        first, second = self._encode(piece)
        raw = piece.encode()
        same = b"".join(map(self.first_bytes.__getitem__, first)) == raw == b"".join(map(self.second_bytes.__getitem__, second))
        for side, ids in zip((self.a, self.b), (first, second)):
            side.append(np.array(ids, np.int32), np.array([len(ids)]))
        self.sound.append(np.array([same]))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids and their number per text for both sides; none for texts that are not given back."""
        if len(self) > _MOST_PIECES or len(self.a.flat) + len(self.b.flat) > _MOST_IDS:
            self.clear()
            self.a.clear()
            self.b.clear()
            self.sound = [np.empty(0, bool)]
        lists = [list(map(self.__getitem__, _PIECE.findall(" " + t))) if t else [] for t in texts]
        if self.pending:
            self._learn()
            self.a.close()
            self.b.close()
            self.sound = [np.concatenate(self.sound)]
        sound = self.sound[0]
        if not sound.all():
            lists = [x if sound[x].all() else [] for x in lists]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        pieces = np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum()))
        return *self.a.of(pieces, counts), *self.b.of(pieces, counts)


@lru_cache(maxsize=1)
def encoders(byte_bpe: str, piece_bpe: str) -> Encoders:
    return Encoders(byte_bpe, piece_bpe)


@dataclass
class Alignment:
    """Groups of a batch: ids end to end, how many tokens each group has of both sides, groups per document."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    over_a: np.ndarray
    over_b: np.ndarray


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of token numbers that share a byte; each side is (document, first byte) of tokens that tile the bytes."""
    import pandas as pd

    left = pd.DataFrame({"doc": a[0], "start": a[1], "a": np.arange(len(a[0]))})
    right = pd.DataFrame({"doc": b[0], "start": b[1], "b": np.arange(len(b[0]))})
    covering_b = pd.merge_asof(left, right, on="start", by="doc")["b"].to_numpy()
    covering_a = pd.merge_asof(right, left, on="start", by="doc")["a"].to_numpy()
    later = a[1][covering_a] != b[1]  # equal starts are found from both sides
    return np.concatenate([left["a"].to_numpy(), covering_a[later]]), np.concatenate([covering_b, right["b"].to_numpy()[later]])


def align_texts(encode: Encoders, texts: list[str]) -> Alignment:
    a_ids, n_a, b_ids, n_b = encode.ids(texts)
    rows = np.arange(len(texts))
    a_end, b_end = np.cumsum(encode.a.sizes[a_ids]), np.cumsum(encode.b.sizes[b_ids])
    a_doc, b_doc = np.repeat(rows, n_a), np.repeat(rows, n_b)
    over_a, over_b = overlaps((a_doc, a_end - encode.a.sizes[a_ids]), (b_doc, b_end - encode.b.sizes[b_ids]))
    closing = a_end[over_a] == b_end[over_b]
    a_last, b_last = np.sort(over_a[closing]), np.sort(over_b[closing])
    n_groups = np.bincount(a_doc[a_last], minlength=len(texts))
    return Alignment(a_ids, b_ids, np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1), n_a, n_b, n_groups, over_a, over_b)


def _list(values: np.ndarray, lengths: np.ndarray, kind=None) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32) if kind is None else values, kind or pa.int32()))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias(key), F.coalesce(f"`{text}`", F.lit("")).alias("_text"))


def _aligner(byte_bpe: str, piece_bpe: str, key: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders(byte_bpe, piece_bpe)
        for batch in batches:
            for first, texts in text_batches(batch, "_text", _MOST_TEXT):
                found = align_texts(encode, texts)
                columns = [
                    batch.column(key).slice(first, len(texts)),
                    _list(found.a_ids, found.n_a),
                    _list(found.b_ids, found.n_b),
                    _list(found.a_sizes, found.n_groups),
                    _list(found.b_sizes, found.n_groups),
                ]
                if "over_a" in names:
                    columns += _overlap_lists(found)
                yield pa.RecordBatch.from_arrays(columns, [key, *names])

    return run


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, key: str = "doc_id", text: str = "text", with_overlaps: bool = False) -> DataFrame:
    """Key, ``a_ids, b_ids`` and for each group how many of them it has, ``a_sizes, b_sizes``.

    ``with_overlaps`` adds ``over_a, over_b``, places of overlapping tokens in the document's ids.
    """
    names = ["a_ids", "b_ids", "a_sizes", "b_sizes", *(["over_a", "over_b"] if with_overlaps else [])]
    fields = [StructField(key, docs.schema[key].dataType), *[StructField(n, ArrayType(IntegerType())) for n in names]]
    return _texts(docs, key, text).mapInArrow(_aligner(byte_bpe, piece_bpe, key, names), StructType(fields))


def _overlap_lists(found: Alignment) -> list[pa.ListArray]:
    a_doc = np.repeat(np.arange(len(found.n_a)), found.n_a)[found.over_a]
    order = np.lexsort((found.over_b, found.over_a))
    counts = np.bincount(a_doc, minlength=len(found.n_a))
    bases = [np.repeat(np.cumsum(n) - n, counts) for n in (found.n_a, found.n_b)]
    return [_list(found.over_a[order] - bases[0], counts), _list(found.over_b[order] - bases[1], counts)]


def _distinct_links(a_ids, b_ids, a_sizes, b_sizes, group_doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and number of occurrences, for groups that are expanded at once."""
    a_first, b_first = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    large = a_sizes * b_sizes > _LARGE_GROUP
    docs, pairs, times = [], [], []
    for g in np.flatnonzero(large):
        a, a_times = np.unique(a_ids[a_first[g] : a_first[g] + a_sizes[g]], return_counts=True)
        b, b_times = np.unique(b_ids[b_first[g] : b_first[g] + b_sizes[g]], return_counts=True)
        pairs.append((a[:, None].astype(np.int64) * SECOND_IDS + b).ravel())
        times.append(np.outer(a_times, b_times).ravel())
        docs.append(np.full(len(pairs[-1]), group_doc[g]))
    small = np.flatnonzero(~large)
    group = np.repeat(small, a_sizes[small])  # of each token of the first side
    a = a_ids[_spread(a_first[small], a_sizes[small])].astype(np.int64)
    partners = b_sizes[group]
    pairs.append(np.repeat(a, partners) * SECOND_IDS + b_ids[_spread(b_first[group], partners)])
    times.append(np.ones(len(pairs[-1]), np.int64))
    docs.append(np.repeat(group_doc[group], partners))
    doc, pair, n = np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((pair, doc))
    doc, pair, n = doc[order], pair[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])) if len(doc) else np.empty(0, np.int64)
    return doc[new], pair[new], np.add.reduceat(n, new) if len(new) else n


@lru_cache(maxsize=1)
def _spelled(first_ids: int, second_ids: int) -> list[bytes]:
    """Every id with what may follow it: a comma or the bar after the first side, a comma or the end after the second."""
    return [b"%d%s" % (i, end) for n, ends in ((first_ids, b",|"), (second_ids, b",;")) for end in (ends[:1], ends[1:]) for i in range(n)]


def _written(a_ids, b_ids, a_sizes, b_sizes, first_ids: int, second_ids: int) -> list[bytes]:
    """The pieces of the groups' text in order, one for each id."""
    total = int(a_sizes.sum() + b_sizes.sum())
    both = a_sizes + b_sizes
    starts = np.cumsum(both) - both
    codes = np.empty(total, np.int64)
    a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_last[np.cumsum(a_sizes) - 1] = b_last[np.cumsum(b_sizes) - 1] = 1
    codes[_spread(starts, a_sizes)] = a_last * first_ids + a_ids
    codes[_spread(starts + a_sizes, b_sizes)] = 2 * first_ids + b_last * second_ids + b_ids
    return list(map(_spelled(first_ids, second_ids).__getitem__, codes.tolist()))


def _link_schema(docs: DataFrame, key: str) -> StructType:
    numbers = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    lists = [StructField(n, ArrayType(LongType())) for n in ("pairs", "times")]
    return StructType([StructField(key, docs.schema[key].dataType), *numbers, StructField("groups_sha256", StringType()), *lists])


def _linker(key: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(n) for n in ("a_ids", "b_ids", "a_sizes", "b_sizes")]
            lengths = [np.diff(x.offsets.to_numpy()) for x in lists]
            tokens = np.cumsum(lengths[0] + lengths[1])
            first = 0
            while first < batch.num_rows:  # runs of rows with a bounded number of tokens, or one row
                before = int(tokens[first - 1]) if first else 0
                after = max(first + 1, int(np.searchsorted(tokens, before + _MOST_TOKENS, "right")))
                flat = [x.slice(first, after - first).flatten().to_numpy() for x in lists]
                counts = [n[first:after] for n in lengths]
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(first, after - first), *_link_columns(*flat, *counts)], names)
                first = after

    return run


def link_rows(aligned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, ``n_a, n_b, n_groups, n_links, groups_sha256``, distinct ``pairs`` and how many ``times`` each is linked."""
    schema = _link_schema(aligned, key)
    return aligned.mapInArrow(_linker(key, schema.names), schema)


def linked(docs: DataFrame, byte_bpe: str, piece_bpe: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``link_rows(align(docs))`` in one pass through the same workers."""
    schema = _link_schema(docs, key)
    encode, link = _aligner(byte_bpe, piece_bpe, key, ["a_ids", "b_ids", "a_sizes", "b_sizes"]), _linker(key, schema.names)
    return _texts(docs, key, text).mapInArrow(lambda batches: link(encode(batches)), schema)


def _link_columns(a_ids, b_ids, a_sizes, b_sizes, n_a, n_b, n_groups, _) -> list[pa.Array]:
    a_ids, b_ids, a_sizes, b_sizes = (x.astype(np.int64) for x in (a_ids, b_ids, a_sizes, b_sizes))
    rows = len(n_a)
    group_doc = np.repeat(np.arange(rows), n_groups)
    n_links = np.zeros(rows, np.int64)
    np.add.at(n_links, group_doc, a_sizes * b_sizes)
    ids = (int(a_ids.max(initial=0)) + 1, int(b_ids.max(initial=0)) + 1)
    spelled = _written(a_ids, b_ids, a_sizes, b_sizes, *(1 << max(16, (n - 1).bit_length()) for n in ids))
    ends = np.cumsum(n_a + n_b)
    digests = [hashlib.sha256(b"".join(spelled[e - n : e])[:-1]).hexdigest() if n else "" for e, n in zip(ends.tolist(), (n_a + n_b).tolist())]
    doc, pair, times = _distinct_links(a_ids, b_ids, a_sizes, b_sizes, group_doc)
    n_pairs = np.bincount(doc, minlength=rows)
    return [
        *[pa.array(n.astype(np.int64)) for n in (n_a, n_b, n_groups, n_links)],
        pa.array(digests, pa.string()),
        _list(pair, n_pairs, pa.int64()),
        _list(times, n_pairs, pa.int64()),
    ]


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, docs, best``: documents that hold each pair, and whether none with its first id is in more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = materialize(counts, "pair_counts").withColumn("a", F.floor(F.col("pair") / SECOND_IDS))
    # One row per id of the first vocabulary.
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _frequent_from(counts: DataFrame, bound: int) -> int:
    """The least power of two that at most ``bound`` pairs reach; from at most 64 rows."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    found = {r["power"]: r["pairs"] for r in counts.groupBy(power).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    least, total = 64, 0
    for p in sorted(found, reverse=True):
        total += found[p]
        if total > bound:
            break
        least = p
    return 1 << min(least, 62)


def corpus_scores(rows: DataFrame, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """``rows`` with ``n_best`` and ``count_sum`` for its ``pairs`` and ``times``; written first, as it is read again."""
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "token_links")
    counts = materialize(pair_counts(rows), "pair_best")
    from_docs = _frequent_from(counts, frequent_pairs)
    links = rows.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("docs") * F.col("times")).alias("count_sum"),
    ]
    frequent = F.broadcast(counts.filter(F.col("docs") >= from_docs))
    scored = links.join(frequent, "pair").groupBy("_row").agg(*sums)
    rare = counts.filter(F.col("docs") < from_docs)
    if not rare.isEmpty():
        others = links.join(frequent, "pair", "left_anti").join(rare.hint("merge"), "pair").groupBy("_row").agg(*sums)
        scored = scored.unionByName(others).groupBy("_row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    return rows.join(scored, "_row", "left").drop("_row").fillna(0, ["n_best", "count_sum"])
