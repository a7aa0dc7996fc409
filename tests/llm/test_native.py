"""Quality rules, license scans and decontamination against brute force."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from gablework.llm import decontaminate, licenses, quality
from gablework.llm.license_rules import LITERALS, PREFILTER, RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(runs)
    hit = {j for i, r in enumerate(runs) if times[r] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def judged(df):
    return df.select("doc_id", "text", "quality.*").collect()


def test_quality_counts(odd, shipped, tables):
    rng = random.Random(1)
    made = [(i, " ".join(rng.choice(["a", "b", "c d", "#", "x\n", "\t", "\x85", "\u2028", "\u2029"]) for _ in range(rng.randint(0, 60))), "") for i in range(200)]
    docs = shipped.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", F.lit("x").alias("k1"))
    for frame in (odd, shipped.createDataFrame(made, odd.schema), docs):
        for r in judged(quality.assess(frame)):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_quality_keeps_clashing_columns(shipped):
    text = "One line of plain words that is long enough to be kept by every rule here."
    names = ["doc_id", "text", "_lost", "_counts", "_whole", "_cleaned", "row", "whole", "quality", "n_chars"]
    docs = shipped.createDataFrame([(1, text, 9, 8, 7, 6, 5, 4, 3, 2)], names)
    judged = quality.assess(docs).first()
    assert [judged[n] for n in names[:8]] == [1, text, 9, 8, 7, 6, 5, 4] and judged.quality.kept
    kept = quality.clean(docs)
    assert kept.columns == names and tuple(kept.first()) == (1, text, 9, 8, 7, 6, 5, 4, 3, len(text))


def test_quality_verdicts(shipped, odd, empty):
    prose = "Here is a sentence with quite ordinary words in it, and one more of them."
    # Words of its own: a second copy of the first line would fail the base rule on repeated windows.
    second = "Nothing said above comes back below, since repeated windows alone would reject this text."
    rows = [
        (1, f"{prose}\nRead more\n{second}", ""),
        (2, "\n".join(" | ".join(f"c{i}{k}" for i in range(6)) for k in range(5)), ""),
        (3, " ".join(f"w{i}***" for i in range(30)), ""),
        (4, " ".join(f"WORD{i}!!" for i in range(30)), ""),
        (5, prose, ""),
    ]
    df = shipped.createDataFrame(rows, odd.schema)
    got = {r.doc_id: r for r in judged(quality.assess(df))}
    assert [i for i in got if got[i].kept] == [1, 5]
    assert "Read more" not in got[1].cleaned and got[5].cleaned == prose
    kept = quality.clean(df.withColumn("n_chars", F.lit(0).cast("long")))
    assert kept.columns == [*df.columns, "n_chars"]
    assert {r.doc_id: r.n_chars for r in kept.collect()} == {1: len(got[1].cleaned), 5: len(prose)}
    assert quality.clean(empty).count() == 0 and quality.clean(odd).columns == odd.columns


def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    found = []
    for label, phrase in licenses.BASE_PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), found


def test_license_base_places(odd, shipped, empty):
    rng = random.Random(2)
    parts = ["CC-BY", "cc", "by", "General Public", "License", "license\n", "ALL  RIGHTS reserved", "all", "rights", "é", "ccé by", "x", ";", "GPL", "\x85", "a\u2028b", "\u2029"]
    made = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25))), "") for i in range(300)]
    for frame in (odd, shipped.createDataFrame(made, odd.schema)):
        for r in licenses.scan(frame).select("text", "licenses.*").collect():
            n, found = base_places(r.text)
            spots = [i for i, _ in found]
            assert (r.n_words, r.n_base) == (n, len(found))
            assert (r.first_word, r.last_word) == ((min(spots), max(spots)) if spots else (None, None))
            assert r.base_labels == sorted({x for _, x in found}) and set(r.base_labels) <= set(r.labels)
            assert 0 <= r.score <= 1
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("Released under the MIT License.", ["mit"]),
        ("This work is licensed under CC BY-NC-SA 4.0", ["cc-by", "cc-by-nc-sa-4.0"]),
        ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0"]),
        ("the GNU Lesser General Public License v2.1", ["gpl", "lgpl-2.1"]),
        ("no such thing here, only prose", []),
    ],
)
def test_license_rules_and_suppression(shipped, odd, text, labels):
    row = licenses.scan(shipped.createDataFrame([(1, text, "")], odd.schema)).select("licenses.labels").first()
    assert row.labels == labels


def test_every_rule_passes_its_prefilters():
    assert len(RULES) > 300 and all(r.gate for r in RULES)
    gates = [re.compile(k.replace("[SEP]", r"[^0-9a-z]+")) for k in PREFILTER]
    for label, text in (("x", " cc0 "), ("x", " licensed under cc by "), ("x", " the gfdl 1 2 "), ("x", " unauthorised copying ")):
        assert any(g.search(text) for g in gates) and any(x in text for x in LITERALS)


SEP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def shingle_list(text):
    words = [w for w in SEP.split((text or "").lower()) if w]
    return len(words), [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute_matches(docs, items):
    out = {}
    for key, text in docs:
        n_doc, have = shingle_list(text)
        for item, item_text in items:
            n, want = shingle_list(item_text)
            bag = collections.Counter(want)
            # Windows as long as the item, cut at the ends of the text.
            for s in range(1 - len(want), len(have) if want else 0):
                own = collections.Counter(have[max(s, 0) : s + len(want)])
                same = sum((own & bag).values())
                value = same / (len(want) + own.total() - same)
                if value >= 0.8 - 1e-12 and value > out.get((key, item), (0,))[0]:
                    out[key, item] = (value, max(s, 0))
    return out


@pytest.mark.parametrize("inline", [50_000, 0])
def test_decontamination_is_exhaustive(shipped, odd, empty, inline):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(5, 70)))) for i in range(12)]
    items += [(90, None), (91, "too short"), (92, items[0][1])]
    docs = []
    for k in range(60):
        words = [rng.choice(voc) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            leak = (rng.choice(items[:12])[1]).split()
            for _ in range(rng.randint(0, 2)):
                spot = rng.choice([0, len(leak) - 1, rng.randrange(len(leak))])
                leak[spot : spot + rng.randint(0, 1)] = [rng.choice(voc)] * rng.randint(0, 1)
            words[(at := rng.randint(0, len(words))) : at] = [w.upper() + "," for w in leak]
        docs.append((k, " ".join(words), ""))
    frame = shipped.createDataFrame(docs, odd.schema)
    benchmark = shipped.createDataFrame(items, "item_id long, text string")
    rules = decontaminate.Decontamination(most_inline_probes=inline)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.matches(frame, benchmark, rules).collect()}
    expected = brute_matches([d[:2] for d in docs], items)
    assert len(expected) > 15
    assert {k: round(v[0], 9) for k, v in got.items()} == {k: round(v[0], 9) for k, v in expected.items()}
    kept = {r.doc_id for r in decontaminate.drop_contaminated(frame, benchmark, rules).collect()}
    assert kept == {d[0] for d in docs} - {k for k, _ in expected}


def test_decontamination_finds_cut_moved_and_long_items(shipped, odd):
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(100)]
    other = [f"v{rng.randrange(5000)}" for _ in range(200)]
    huge = [f"u{rng.randrange(30_000)}" for _ in range(100_000)]
    docs = [
        (1, " ".join(words[:95]), ""),
        (2, " ".join(words[50:] + words[:50]), ""),
        (3, " ".join(other[:60] + words[50:] + words[:50] + other[60:]), ""),
        (4, " ".join(words[12:] + other), ""),
        (5, " ".join(other + words[:85]), ""),
        (6, " ".join(words[:70]), ""),
        (7, " ".join(other[:9] + huge[5:] + other), ""),
        (8, " ".join(other), ""),
        (9, " ".join(words) + ", \x85", ""),
    ]
    benchmark = shipped.createDataFrame([(1, " ".join(words)), (2, " ".join(huge))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (round(r.similarity, 6), r.start) for r in decontaminate.matches(shipped.createDataFrame(docs, odd.schema), benchmark).collect()}
    expected = brute_matches([d[:2] for d in docs if d[0] != 7], [(1, " ".join(words))])
    assert {k for k, _ in expected} == {1, 2, 3, 4, 5, 9}
    assert got.pop((7, 2))[1] in range(4, 10)
    assert {k: v[0] for k, v in got.items()} == {k: round(v[0], 6) for k, v in expected.items()}


def test_decontamination_keeps_clashing_columns(shipped):
    schema = "doc_id long, text string, k1 string, k2 string, _k1 long, item string, `row` string, hash string, no int"
    rows = [(1, "null key, some words here", "a", "b", 3, "c", "d", "e", 4), (2, "other words", "a", "b", 3, "c", "d", "e", 4)]
    docs = shipped.createDataFrame(rows, schema)
    benchmark = shipped.createDataFrame([(1, "null key, some words here")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.drop_contaminated(docs, benchmark).collect()] == rows[1:]
    assert [r.asDict()["k1"] for r in decontaminate.matches(docs, benchmark, key="k1").collect()] == ["a"]


@pytest.mark.parametrize("limit", [0])
def test_decontamination_without_broadcast(shipped, odd, limit):
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(20))) for i in range(5)]
    docs = [(k, " ".join([*["x"] * k, items[k % 5][1], *["y"] * k]), "") for k in range(15)]
    frame, benchmark = shipped.createDataFrame(docs, odd.schema), shipped.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(frame, benchmark, decontaminate.Decontamination(most_broadcast=limit)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(brute_matches([d[:2] for d in docs], items))


def test_decontamination_odd_rows(shipped, odd, empty):
    benchmark = shipped.createDataFrame([(1, "null key, some words here"), (2, None)], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.matches(odd, benchmark).select("doc_id", "item_id", "start").collect()] == [(None, 1, 0)]
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontaminate.drop_contaminated(empty, benchmark).count() == 0
    assert decontaminate.drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()
