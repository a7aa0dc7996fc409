"""Token alignment against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from gablework.llm import alignment
from gablework.llm.queries import byte_bpe, piece_bpe

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def encode():
    return alignment.Encoders(byte_bpe(), piece_bpe())


def library_tokens(encode, text):
    """Ids of whole texts as the libraries encode them; none unless both give the bytes back."""
    if not text:
        return [], []
    raw = (" " + text).encode()
    a = encode.first.encode(" " + text, add_special_tokens=False).ids
    b = encode.second.encode(text, num_threads=1)
    same = b"".join(encode.first_bytes[i] for i in a) == raw == b"".join(encode.second_bytes[i] for i in b)
    return (a, b) if same else ([], [])


def brute_groups(encode, a, b):
    """Tokens are taken from whichever side is behind; a group closes when both are at the same byte."""
    groups, own, other, i, j, at, bt = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at <= bt:
            own.append(a[i])
            at += len(encode.first_bytes[a[i]])
            i += 1
        else:
            other.append(b[j])
            bt += len(encode.second_bytes[b[j]])
            j += 1
        if at == bt:
            groups.append((own, other))
            own, other = [], []
    return groups


def brute_rows(encode, rows):
    aligned = [(key, *(pair := library_tokens(encode, text)), brute_groups(encode, *pair)) for key, text in rows]
    docs = Counter()
    for *_, groups in aligned:
        docs.update({(x, y) for g, h in groups for x in g for y in h})
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    found = []
    for key, a, b, groups in aligned:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if a else ""
        n_best = sum(docs[p] == most[p[0]] for p in links)
        found.append((key, len(a), len(b), len(groups), len(links), n_best, sum(docs[p] for p in links), sha))
    return sorted(found, key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(docs, **options):
    linked = alignment.linked(docs, byte_bpe(), piece_bpe())
    return sorted([tuple(r) for r in alignment.corpus_scores(linked, **options).select(*COLUMNS).collect()], key=str)


def test_encoding_equals_the_libraries(encode):
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(4)
    bits = ["a", "'s", "'", "12", " ", "  ", "\n", "\t", "\r\n", "é", "日本", "😀", "<|endoftext|>", "</s>", "<0x41>", "▁", "\x85", "\xa0", "\x1c", " ", "　", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(2_000)]
    texts += ["".join(every[k : k + 50]) for k in range(0, len(every), 400)]
    texts += [f"x{c} {c}y{c}\n{c}  {c} " for c in [*every[:0x250], *every[0x1FF0:0x2070], *every[0x2FF0:0x3050]]]
    for k in range(0, len(texts), 500):
        a, n_a, b, n_b = encode.ids(texts[k : k + 500])
        a_ends, b_ends = np.cumsum(n_a), np.cumsum(n_b)
        for i, text in enumerate(texts[k : k + 500]):
            own = a[a_ends[i] - n_a[i] : a_ends[i]].tolist(), b[b_ends[i] - n_b[i] : b_ends[i]].tolist()
            assert own == library_tokens(encode, text), repr(text)


def test_table_equals_brute_force(shipped, tables, encode):
    docs = shipped.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    expected = brute_rows(encode, [tuple(r) for r in docs.collect()])
    assert rows_of(docs) == expected
    assert rows_of(docs.repartition(6), frequent_pairs=50) == expected
    assert rows_of(docs, frequent_pairs=0) == expected
    apart = alignment.link_rows(alignment.align(docs, byte_bpe(), piece_bpe()))
    assert sorted(map(str, apart.collect())) == sorted(map(str, alignment.linked(docs, byte_bpe(), piece_bpe()).collect()))


def test_odd_rows(odd, empty, encode):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(9, "a ▁ b"), (10, "x" * 5_000), (11, "日" * 3_000), (12, "0" * 4_001 + "\n" * 300)]
    docs = odd.sparkSession.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(docs) == brute_rows(encode, rows)
    assert rows_of(empty) == []


def test_large_groups_are_counted_by_distinct_ids():
    rng = np.random.default_rng(5)
    a_sizes, b_sizes = np.array([300, 1, 2, 90]), np.array([200, 1, 3, 80])
    a_ids, b_ids = rng.integers(0, 9, a_sizes.sum()), rng.integers(0, 7, b_sizes.sum())
    group_doc = np.array([0, 0, 1, 2])
    expected, a, b = Counter(), 0, 0
    for doc, n, m in zip(group_doc, a_sizes, b_sizes):
        expected.update((doc, x, y) for x in a_ids[a : a + n].tolist() for y in b_ids[b : b + m].tolist())
        a, b = a + n, b + m
    doc, pair, times = alignment._distinct_links(a_ids, b_ids, a_sizes, b_sizes, group_doc)
    found = {(d, p // alignment.SECOND_IDS, p % alignment.SECOND_IDS): n for d, p, n in zip(doc.tolist(), pair.tolist(), times.tolist())}
    assert found == expected


def test_overlaps_are_all_pairs_that_share_a_byte(shipped, encode):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abc de,1é日 ") for _ in range(40))) for i in range(30)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    for r in alignment.align(docs, byte_bpe(), piece_bpe(), with_overlaps=True).collect():
        a_end = np.cumsum([len(encode.first_bytes[i]) for i in r.a_ids])
        b_end = np.cumsum([len(encode.second_bytes[i]) for i in r.b_ids])
        a_start, b_start = np.concatenate([[0], a_end[:-1]]), np.concatenate([[0], b_end[:-1]])
        shared = (a_start[:, None] < b_end) & (b_start[None, :] < a_end[:, None])
        assert list(zip(r.over_a, r.over_b)) == list(zip(*(x.tolist() for x in np.nonzero(shared))))
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)
