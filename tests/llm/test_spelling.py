"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from gablework.llm import spelling


def brute_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6}


def neighbours(word, alphabet):
    near = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in alphabet:
        near |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
        near |= {word[:i] + c + word[i + 1 :] for i in range(len(word))}
    return near - {word}


def brute_variants(counts):
    words = {w: n for w, n in counts.items() if n >= 5}
    alphabet = sorted({c for w in words for c in w})
    near = {w: sorted(neighbours(w, alphabet) & words.keys(), key=lambda x: (-words[x], x)) for w in words}
    form = {w: near[w][0] if near[w] and words[near[w][0]] >= 5 * words[w] else None for w in words}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def made(seed, n_words, alphabet="abcdeé"):
    """Counts of words and of their edits, up to chains of edits, with ties."""
    rng = random.Random(seed)
    counts = {}
    for _ in range(n_words):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9)))
        n = rng.choice([3_000, 600, 120, 25, 5])
        while n >= 1 and len(word) >= 6:
            counts.setdefault(word, n)
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice([rng.choice(alphabet), "", word[at] + rng.choice(alphabet)]) + word[at + 1 :]
            n = rng.choice([n, n // 5, n // 6])
            if rng.random() < 0.2:
                break
    return counts


@pytest.mark.parametrize("block_rows", [2_048, 7])
def test_variants_equal_brute_force(shipped, block_rows):
    counts = made(1, 500)
    counted = shipped.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    found = sorted((tuple(r) for r in spelling.variants(counted, block_rows=block_rows).collect()))
    assert found == brute_variants(counts)
    assert sum(r[1] is not None for r in found) > 20 and any(r[2] not in (r[0], r[1]) for r in found)


def test_table_equals_brute_force(shipped, tables):
    docs = shipped.read.parquet(f"{tables}/documents.parquet")
    counts = brute_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    counted = spelling.count_words(docs)
    assert {r.word: r.n for r in counted.collect()} == counts
    assert sorted((tuple(r) for r in spelling.variants(counted).collect())) == brute_variants(counts)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(8, "ÀÁÂÃÄÅ ÀÁÂÃÄÅ × ABCDEFÿ x_abcdef1 ßßßßßß")]
    docs = odd.sparkSession.createDataFrame(rows, "doc_id long, text string").union(odd.limit(0).select("doc_id", "text"))
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == brute_counts(rows)
    assert spelling.count_words(empty).count() == 0
    assert spelling.variants(spelling.count_words(empty)).count() == 0


def test_spoiling_and_edits():
    words = [f"word{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(2_000)]
    spoiled = [w for w in words if spelling.spoil(w, "7") != w]
    assert 1 <= len(spoiled) <= 40 and all(len(spelling.spoil(w, "7")) == len(w) - 1 for w in spoiled)
    rng = random.Random(2)
    for _ in range(3_000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 5)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 5)))
        assert spelling.one_edit(a, b) == (b in neighbours(a, "ab"))
