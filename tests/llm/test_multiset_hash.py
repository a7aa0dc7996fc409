"""Multiset fingerprints: equality, homomorphism, likeness, edited texts."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gablework.llm import multiset_hash as mh
from gablework.llm.successors import in_key_order, with_next

PARAGRAPHS = ["one two three four", "five six", "", "alpha beta gamma delta epsilon", "é ß 😀", "one two three four"]


def one(text):
    return mh.to_text(mh.vectors([text]))[0]


def alike(a, b):
    return float(mh.likeness(mh.from_text([a]), mh.from_text([b]))[0])


def test_order_does_not_matter_but_contents_and_counts_do():
    rng = random.Random(3)
    base = one("\n".join(PARAGRAPHS))
    for _ in range(10):
        mixed = rng.sample(PARAGRAPHS, len(PARAGRAPHS))
        assert one("\n".join(mixed)) == base
    others = ["\n".join(PARAGRAPHS[1:]), "\n".join([*PARAGRAPHS, ""]), "\n".join(PARAGRAPHS) + " ", " ".join(PARAGRAPHS)]
    assert len({base, *map(one, others)}) == 5


def test_sums_and_increments():
    a, b = "\n".join(PARAGRAPHS[:3]), "\n".join(PARAGRAPHS[3:])
    both = one(a + "\n" + b)
    assert mh.insert(one(a), b) == both == mh.insert(one(b), a)
    assert mh.delete(both, a) == one(b)
    assert mh.delete(mh.delete(both, PARAGRAPHS[1]), PARAGRAPHS[4]) == one("\n".join([PARAGRAPHS[i] for i in (0, 2, 3, 5)]))
    many, counts = mh.vectors([a, b, ""])
    assert mh.to_text((many, counts)) == [one(a), one(b), one("")]


def test_likeness_follows_the_exact_share():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5_000)]
    base = [rng.choice(vocabulary) for _ in range(2_000)]
    for kept in (0, 500, 1_000, 1_500, 2_000):
        other = base[:kept] + [rng.choice(vocabulary) for _ in range(2_000 - kept)]
        assert abs(alike(one(" ".join(base)), one(" ".join(other))) - kept / 2_000) < 0.25
    assert alike(one("a b c"), one("a b c")) == 1.0 and alike(one(""), one("")) == 1.0
    assert alike(one(""), one("a b c")) == 0.0


def test_fingerprint_keeps_rows_and_columns(odd, empty):
    found = mh.fingerprint(odd)
    assert found.columns == [*odd.columns, "fingerprint"]
    rows = [(r.doc_id, r.fingerprint) for r in found.collect()]
    assert sorted(rows, key=str) == sorted([(r.doc_id, one(r.text or "")) for r in odd.collect()], key=str)
    assert mh.fingerprint(empty).count() == 0
    with pytest.raises(ValueError):
        mh.fingerprint(odd, output="k1")


def test_collections_add_up(shipped, empty):
    rows = [(i, f"line {i}\nshared line", "hot" if i % 3 else f"s{i % 4}") for i in range(200)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    prints = mh.fingerprint(docs)
    found = {r.source: (r.n_documents, r.fingerprint) for r in mh.add_up(prints, ["source"]).collect()}
    for source in {r[2] for r in rows}:
        texts = [r[1] for r in rows if r[2] == source]
        assert found[source] == (len(texts), one("\n".join(texts)))
    assert [r.fingerprint for r in mh.add_up(prints).collect()] == [one("\n".join(r[1] for r in rows))]
    assert mh.add_up(mh.fingerprint(empty), ["k1"]).count() == 0
    assert mh.add_up(mh.fingerprint(empty)).count() == 0


def expected_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    found = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        found.append((key, len(text), sha, one(text), one(edited), alike(one(text), one(edited)), alike(one(text), one(after))))
    return sorted(found, key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_edits_equal_brute_force(shipped, tables, parts):
    docs = shipped.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted([tuple(r) for r in mh.edits(docs.orderBy(F.rand(4)).repartition(parts)).collect()], key=str)
    assert found == expected_edits(rows)


def test_edits_of_odd_rows(shipped, odd, empty):
    assert mh.edits(odd).count() == odd.count()
    assert mh.edits(empty).count() == 0
    alone = shipped.createDataFrame([(7, "abcdé")], "doc_id long, text string")
    assert [tuple(r) for r in mh.edits(alone).collect()] == expected_edits([(7, "abcdé")])
    named = shipped.createDataFrame([("b", "x y z w"), ("a", None), (None, "q")], "id string, body string")
    found = {r.id: r.n_chars for r in mh.edits(named, "id", "body").collect()}
    assert found == {"b": 7, "a": 0, None: 1}


def test_every_row_meets_its_successor_once(shipped):
    def pairs(batches):
        rows = [(key, after) for key, _, after in with_next(batches)]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["k", "n"])

    docs = shipped.range(2_000).selectExpr("id * 3 as k", "concat('t', id) as t").repartition(9)
    found = {(r.k, r.n) for r in in_key_order(docs, "k", "t").mapInArrow(pairs, "k bigint, n string").collect()}
    assert found == {(3 * i, f"t{(i + 1) % 2_000}") for i in range(2_000)}
