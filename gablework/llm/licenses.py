"""License scans: ordered signature rules behind a keyword prefilter.

One regular expression decides from the raw text whether any rule can match; the rest of
the work is done for those texts alone. They are brought to normal form (lower case,
single blanks), each rule whose own keyword occurs is run over it, and matches become
word intervals with a priority. A detection inside another of higher priority goes, so
that "licensed under CC BY-NC 4.0" is not also CC BY. Survivors give labels and score.

All of it is expressions over one row: one scan, no shuffle, no Python.

Defined cases: null text counts as empty; texts without a match have no labels and score
0; repeated rows get equal results; the other columns pass through, except that a column
named ``licenses`` is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.license_rules import LITERALS, PREFILTER, RULES, Rule
from gablework.llm.native import let

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose word places are reported whatever the rules decide.
BASE_PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def normal_form(text: Column) -> Column:
    """Words in lower case (A-Z only), one blank before, between and after them."""
    lower = F.translate(text, UPPER, LOWER)
    return F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(lower, F.lit(f"({WORD})"), F.lit(1)), " "), F.lit(" "))


def places(form: Column, pattern: Column | str) -> Column:
    """Word intervals ``(start, end)`` of all matches of a pattern, from left to right.

    Matches are found with the stretch before each, anchored to the end of the one before,
    so that one pass suffices; blanks in the stretches count words.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    stepped = F.concat(F.lit("(?s)\\G(.*?(?= ))( (?:"), pattern, F.lit(")(?= ))"))

    def blanks(x: Column) -> Column:
        return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))

    def collect(gaps: Column, hits: Column) -> Column:
        both = F.transform(hits, lambda h, i: F.struct(F.get(gaps, i).alias("gap"), h.alias("hit")))
        empty = F.array().cast("array<struct<start:int,end:int>>")

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + blanks(x["gap"])
            end = start + blanks(x["hit"])
            found = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
            return F.struct(end.cast("int").alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        return F.aggregate(both, start, step, lambda s: s["found"])

    gaps = F.regexp_extract_all(form, stepped, F.lit(1))
    hits = F.regexp_extract_all(form, stepped, F.lit(2))
    return let(gaps, lambda g: let(hits, lambda h: collect(g, h)))


def prefilter(text: Column) -> Column:
    """Whether any rule or base phrase can match, on the text as it is."""
    keywords = "|".join(k.replace("[SEP]", SEPARATOR) for k in PREFILTER)
    literal = let(F.lower(text), lambda t: reduce(or_, [F.contains(t, F.lit(x)) for x in LITERALS]))
    return literal & text.rlike(f"(?i)(?:{keywords})")


def detections(form: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All matches of all rules whose keyword occurs, before suppression."""
    table = F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"), F.lit(r.gate).alias("gate"),
                F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"), F.lit(i).alias("rank"),
            )
            for i, r in enumerate(rules)
        ]
    )

    def run(rule: Column) -> Column:
        return F.transform(
            places(form, rule["pattern"]),
            lambda p: F.struct(
                rule["label"].alias("label"), p["start"].alias("start"), p["end"].alias("end"),
                rule["priority"].alias("priority"), rule["confidence"].alias("confidence"), rule["rank"].alias("rank"),
            ),
        )

    gated = F.filter(table, lambda r: F.contains(form, r["gate"]))
    matching = F.filter(gated, lambda r: F.call_function("rlike", form, F.concat(F.lit(" (?:"), r["pattern"], F.lit(") "))))
    return F.flatten(F.transform(matching, run))


def surviving(found: Column) -> Column:
    """Detections not contained in one of higher priority (ties: the longer, then the earlier rule)."""

    def beaten(d: Column, e: Column) -> Column:
        inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
        longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
        equal = (e["end"] - e["start"]) == (d["end"] - d["start"])
        stronger = e["priority"] > d["priority"]
        tie = e["priority"] == d["priority"]
        return inside & (stronger | (tie & (longer | (equal & (e["rank"] < d["rank"])))))

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beaten(d, e)))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The input with a column ``licenses``: word count, base places, detections, labels, score."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    form = F.col("_form")
    nowhere = F.array().cast("array<struct<start:int,end:int>>")
    bases = F.struct(
        *[F.when(F.contains(form, F.lit(f" {p} ")), places(form, p)).otherwise(nowhere).alias(label) for label, p in BASE_PHRASES]
    )
    gated = docs.withColumns({"_words": n_words(whole), "_form": F.when(prefilter(whole), normal_form(whole))})
    none_found = F.array().cast(
        "array<struct<label:string,start:int,end:int,priority:int,confidence:double,rank:int>>"
    )
    found = gated.withColumns(
        {
            "_base": F.when(F.col("_form").isNotNull(), bases),
            "_all": F.when(F.col("_form").isNotNull(), let(F.col("_form"), lambda f: detections(f, rules))),
        }
    ).withColumn("_kept", F.coalesce(let(F.col("_all"), surviving), none_found))
    spots = F.concat(*[F.coalesce(F.col("_base")[label]["start"], F.array().cast("array<int>")) for label, _ in BASE_PHRASES])
    base_labels = F.filter(
        F.array(*[F.when(F.size(F.col("_base")[label]) > 0, F.lit(label)) for label, _ in BASE_PHRASES]), lambda x: x.isNotNull()
    )
    shaped = found.withColumns({"_spots": spots, "_base_labels": base_labels})
    own = F.transform(F.col("_kept"), lambda d: d["label"])
    labels = F.array_sort(F.array_distinct(F.concat(F.col("_base_labels"), own)))
    score = F.greatest(
        F.coalesce(F.array_max(F.transform(F.col("_kept"), lambda d: d["confidence"])), F.lit(0.0)),
        F.when(F.size("_spots") > 0, F.lit(0.5)).otherwise(F.lit(0.0)),
    )
    licenses = F.struct(
        F.col("_words").alias("n_words"),
        F.size("_spots").cast("long").alias("n_base"),
        F.array_min("_spots").cast("long").alias("first_word"),
        F.array_max("_spots").cast("long").alias("last_word"),
        F.array_sort("_base_labels").alias("base_labels"),
        labels.alias("labels"),
        score.alias("score"),
        F.col("_kept").alias("detections"),
    )
    return shaped.select(*[F.col(f"`{c}`") for c in docs.columns if c != "licenses"], licenses.alias("licenses"))
