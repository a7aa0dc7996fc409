"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs, the pieces between line feeds, taken exactly. Each paragraph is hashed
to one wide vector, and a text's fingerprint is the sum of these, lane by lane, modulo powers of two:

- 16 lanes modulo 2**64 hold the output of SHAKE-128 on the paragraph. Two texts with equal lanes hold the same
  paragraphs equally often, in any order.
- 256 lanes modulo 2**32 hold a signed count of the paragraph's runs of three words (of all its words, if fewer):
  each run adds or takes one in one lane. Lane products estimate how much content two texts share, also where
  paragraphs differ only in part.

So ``fingerprint(a + "\\n" + b)`` is the sum of both, paragraphs can be added or taken away without the rest
of the text, and fingerprints of documents add up to that of a collection. Likeness is twice the product of the
counting lanes over the sum of their squares, between 0 and 1: the share of squared run counts in common,
with a standard error of about 1/16 for texts that share nothing. Equal fingerprints are alike by 1.

Defined cases: null text counts as empty, which is one empty paragraph; very long texts are hashed whole, one at
a time; repeated paragraphs count as often as they stand; repeated rows and equal or null keys are kept; an empty
table gives no rows; a column named like the output is an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from gablework.llm import words
from gablework.llm.pretokens import text_batches
from gablework.llm.successors import in_key_order, with_next

EXACT, COUNTS, RUN = 16, 256, 3
_RUN_BASE = words.SECOND
# Texts hashed at once: characters, and rows.
_MOST_TEXT, _MOST_ROWS = 1 << 20, 2_000


def vectors(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed lanes of each text: ``(n, 16)`` modulo 2**64 and ``(n, 256)`` modulo 2**32."""
    pieces = [t.encode().split(b"\n") for t in texts]
    counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = [p for piece in pieces for p in piece]
    if not flat:
        return np.zeros((0, EXACT), np.uint64), np.zeros((0, COUNTS), np.uint32)
    seen: dict[bytes, int] = {}
    which = [seen.setdefault(p, len(seen)) for p in flat]
    digests = b"".join([hashlib.shake_128(p).digest(8 * EXACT) for p in seen])
    wide = np.frombuffer(digests, "<u8").reshape(-1, EXACT)
    starts = np.cumsum(counts) - counts
    exact = np.add.reduceat(wide[which], starts, axis=0)

    found = words.split(flat)
    first, size = found.first[:-1], np.diff(found.first)
    runs = np.where(size >= RUN, size - RUN + 1, np.minimum(size, 1))
    owner = np.repeat(np.arange(len(texts)), np.add.reduceat(runs, starts))
    ends = np.cumsum(runs)
    at = np.repeat(first - (ends - runs), runs) + np.arange(int(ends[-1]))
    length = np.repeat(np.minimum(size, RUN), runs)
    hashes = found.runs(found.prefix(_RUN_BASE), _RUN_BASE, at, length)
    lanes = owner * COUNTS + (hashes % np.uint64(COUNTS)).astype(np.int64)
    signs = 1.0 - 2.0 * ((hashes >> np.uint64(40)) & np.uint64(1))
    sums = np.bincount(lanes, weights=signs, minlength=len(texts) * COUNTS).reshape(-1, COUNTS)
    return exact, sums.astype(np.int64).astype(np.uint32)


def likeness(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each pair of rows; 1 where the exact lanes agree."""
    a, b = (x[1].astype(np.uint32).view(np.int32).astype(np.float64) for x in (one, two))
    size = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    shared = np.divide(2 * (a * b).sum(axis=1), size, out=np.zeros(len(a)), where=size > 0)
    return np.where((one[0] == two[0]).all(axis=1), 1.0, np.clip(shared, 0.0, 1.0))


def to_text(lanes: tuple[np.ndarray, np.ndarray]) -> list[str]:
    exact, counts = lanes[0].astype("<u8"), lanes[1].astype("<u4")
    return [base64.b64encode(e.tobytes() + c.tobytes()).decode() for e, c in zip(exact, counts)]


def from_text(fingerprints: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(map(base64.b64decode, fingerprints)), np.uint8).reshape(len(fingerprints), -1)
    split = 8 * EXACT
    return np.ascontiguousarray(raw[:, :split]).view("<u8"), np.ascontiguousarray(raw[:, split:]).view("<u4")


def insert(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` are added, in any place."""
    (exact, counts), (more, more_counts) = from_text([fingerprint]), vectors([text])
    return to_text((exact + more, counts + more_counts))[0]


def delete(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` are taken away."""
    (exact, counts), (less, less_counts) = from_text([fingerprint]), vectors([text])
    return to_text((exact - less, counts - less_counts))[0]


def fingerprint(docs: DataFrame, text: str = "text", output: str = "fingerprint") -> DataFrame:
    """All columns and the fingerprint of every whole text."""
    if output in docs.columns:
        raise ValueError(f"column {output} is already there")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, text):
                prints = pa.array(to_text(vectors(texts)), pa.string())
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, prints], [*part.schema.names, output])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(output, StringType()))


def add_up(fingerprints: DataFrame, by: Sequence[str] = (), column: str = "fingerprint") -> DataFrame:
    """One fingerprint for each group: that of all its documents' paragraphs together.

    Lanes are added in each task before the shuffle, which carries one row per group and task;
    a group that holds most of the rows costs no task more than the others.
    """
    by = list(by)
    keys = fingerprints.select(*[f"`{c}`" for c in by]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            prints = batch.column(column).to_pylist()
            if not prints:
                continue
            owners = zip(*[batch.column(c).to_pylist() for c in by]) if by else [()] * len(prints)
            groups: dict[tuple, list[int]] = {}
            for i, owner in enumerate(owners):
                groups.setdefault(owner, []).append(i)
            exact, counts = from_text(prints)
            for owner, rows in groups.items():
                held = sums.setdefault(owner, [0, np.zeros(EXACT, np.uint64), np.zeros(COUNTS, np.uint32)])
                held[0] += len(rows)
                held[1] = held[1] + exact[rows].sum(axis=0, dtype=np.uint64)
                held[2] = held[2] + counts[rows].sum(axis=0, dtype=np.uint32)
            if len(sums) > 20_000:
                yield _totals(sums, batch)
                sums = {}
            last = batch
        if sums:
            yield _totals(sums, last)

    def _totals(sums: dict[tuple, list], batch: pa.RecordBatch) -> pa.RecordBatch:
        """Lanes as 32-bit halves, whose sums stay far from the bounds of a long."""
        halves = [np.concatenate([e.astype("<u8").view("<u4"), c]).astype(np.int64) for _, e, c in sums.values()]
        kept = [pa.array([owner[i] for owner in sums], batch.schema.field(c).type) for i, c in enumerate(by)]
        parts = pa.array([h.tolist() for h in halves], pa.list_(pa.int64()))
        counted = pa.array([held[0] for held in sums.values()], pa.int64())
        return pa.RecordBatch.from_arrays([*kept, counted, parts], [*by, "_n", "_halves"])

    chosen = fingerprints.select(*[f"`{c}`" for c in by], f"`{column}`")
    partial = chosen.mapInArrow(run, StructType([*keys.fields]).add("_n", LongType()).add("_halves", ArrayType(LongType())))
    n_halves = 2 * EXACT + COUNTS
    sums = [F.sum(F.col("_halves")[i]).alias(f"_h{i}") for i in range(n_halves)]
    grouped = partial.groupBy(*[f"`{c}`" for c in by]).agg(F.sum("_n").alias("n_documents"), *sums)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or batch.column("n_documents")[0].as_py() is None:
                continue
            parts = [batch.column(f"_h{i}").to_numpy(zero_copy_only=False).astype(np.uint64) for i in range(n_halves)]
            # What a low half carries over belongs to the high half.
            exact = np.stack([parts[2 * i] + (parts[2 * i + 1] << np.uint64(32)) for i in range(EXACT)], axis=1)
            counts = np.stack(parts[2 * EXACT :], axis=1).astype(np.uint32)
            kept = [batch.column(c) for c in [*by, "n_documents"]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(to_text((exact, counts)))], [*by, "n_documents", column])

    return grouped.mapInArrow(close, StructType([*keys.fields]).add("n_documents", LongType()).add(column, StringType()))


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text against an edited form of it: its last half replaced by as much of the next document's start.

    Columns: key, ``n_chars``, ``edited_sha256``, both fingerprints, and their likeness to each other
    and of the text's to the next document's.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in with_next(batches):
            held.append(row)
            size += len(row[1])
            if size >= _MOST_TEXT or len(held) >= _MOST_ROWS:
                yield _edited(held)
                held, size = [], 0
        if held:
            yield _edited(held)

    def _edited(rows: list[tuple]) -> pa.RecordBatch:
        keys, texts, following = (list(x) for x in zip(*rows))
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following)]
        # A text mostly follows its predecessor here, so few are hashed twice.
        number = {t: i for i, t in enumerate(dict.fromkeys([*texts, *following, *edited]))}
        exact, counts = vectors(list(number))

        def of(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
            at = [number[t] for t in some]
            return exact[at], counts[at]

        own, new, after = of(texts), of(edited), of(following)
        columns = [
            pa.array(list(map(len, texts)), pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(to_text(own)),
            pa.array(to_text(new)),
            pa.array(likeness(own, new)),
            pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *columns], names)

    ordered = in_key_order(docs, key, text)
    key_type = to_arrow_type(docs.schema[key].dataType)
    schema = f"`{key}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)
