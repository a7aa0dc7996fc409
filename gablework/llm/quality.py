"""Quality rules: line-first cleaning, then rejection of documents that lose too much text.

Everything is a per-row expression: one scan, no shuffle, no Python. A row of any length is
handled in time proportional to n log n of its words.

Lines are judged one by one. A line goes if it is a table row or menu (several separators),
mostly symbols, shouted with many marks, a known boilerplate phrase with little else, or one
or two words without punctuation or digits. What is left, joined by line breaks, is the cleaned text; a document keeps its place
if enough of its non-blank characters survive.

Defined cases: null text counts as empty; empty text has no words and fails the base rule;
equal rows get equal verdicts; other columns are passed through untouched, save that a column
named ``quality`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.native import indices, let

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5

# What menus, consent notes and page furniture say; matched as whole words, any case.
BOILERPLATE = (
    r"(?i)\b(?:cookie policy|accept (?:all )?cookies|uses cookies|privacy policy|terms (?:of use|of service|and conditions)"
    r"|enable javascript|javascript is disabled|subscribe to our newsletter|sign up for our newsletter|click here"
    r"|read more|share this|follow us on|log ?in|sign ?in|sign ?up|back to top|skip to content|lorem ipsum"
    r"|add to cart|page not found|advertisement)\b"
)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the rules; shares are of a line's or a document's non-blank characters."""

    least_words: int = 10
    most_repeat_percent: int = 20
    most_separators: int = 3
    most_symbol_share: float = 0.10
    longest_furniture: int = 120
    longest_stub: int = 40
    most_shouted_share: float = 0.10
    most_lost_share: float = 0.5


def characters_of(text: Column, pattern: str) -> Column:
    """How many characters a class matches."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def words_of(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^{BLANK}+|{BLANK}+\\z", "")
    return F.when(trimmed != "", F.split(trimmed, f"{BLANK}+", -1)).otherwise(F.array().cast("array<string>"))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of consecutive words that occur twice or more in the text.

    Most texts repeat no window, which comparing the number of distinct window hashes
    tells. For the others the hashes are sorted with their places; equal neighbours are
    repeats, and the gaps between their places say how many words they cover.
    """

    def of_windows(h: Column) -> Column:
        return F.transform(
            indices(F.size(h) - (window - 1)), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])
        )

    def covered(sorted_places: Column) -> Column:
        def step(state: Column, place: Column) -> Column:
            fresh = F.least(F.lit(window), place - state["last"])
            return F.struct((state["n"] + fresh).alias("n"), place.alias("last"))

        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(sorted_places, start, step, lambda s: s["n"].cast("long"))

    def places(hashes: Column) -> Column:
        keyed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def repeats(s: Column) -> Column:
            def same(x: Column, i: Column) -> Column:
                before = (i > 0) & (F.get(s, i - 1)["h"] == x["h"])
                return F.coalesce(before | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), F.lit(False))

            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        return let(F.sort_array(keyed), repeats)

    def count(hashes: Column) -> Column:
        clean = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(clean, F.lit(0).cast("long")).otherwise(covered(places(hashes)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: let(of_windows(h), count))


def line_verdict(line: Column, rules: QualityRules) -> Column:
    """Whether a line with words stays."""
    solid = F.length(F.regexp_replace(line, f"{BLANK}+", ""))
    separators = F.regexp_count(line, F.lit(r"[|»•]"))
    table = (separators > rules.most_separators) | (
        (separators > 0) & (separators * 2 >= F.regexp_count(line, F.lit(WORD)))
    )
    junk = F.regexp_count(line, F.lit(SYMBOL)) > solid * F.lit(rules.most_symbol_share)
    loud = F.regexp_count(line, F.lit("!")) > solid * F.lit(rules.most_shouted_share)
    marked = line.rlike(r"[|»•#*$%&<>!]") & (table | junk | loud)
    furniture = (F.length(line) <= rules.longest_furniture) & line.rlike(BOILERPLATE)
    stub = (F.length(line) <= rules.longest_stub) & line.rlike(r"^\s*[^\s\d]+(?:\s+[^\s\d]+)?(?<![.!?:;,…\"')\]”»])\s*$")
    return ~(marked | furniture | stub)


def assess(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """The input with one more column ``quality``: base counts, verdict and cleaned text.

    The steps are separate projections of plain columns, so that none is computed twice.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = let(
        words_of(whole),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    cleaning = let(
        F.split(whole, "\n", -1),
        lambda lines: let(
            F.filter(lines, lambda x: ~x.rlike(WORD) | line_verdict(x, rules)),
            lambda kept: F.when(F.size(kept) < F.size(lines), F.array_join(kept, "\n")),
        ),
    )
    # The row travels as one column, so no name of its columns can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "quality"]).alias("row")
    staged = docs.select(row, whole.alias("_whole"), counts.alias("_counts"), cleaning.alias("_cleaned"))
    whole = F.col("_whole")
    staged = staged.withColumns(
        {
            "_n_symbols": characters_of(whole, SYMBOL),
            "_n_dup_lines": repeated_lines(whole),
            "_lost": F.when(
                F.col("_cleaned").isNotNull(), characters_of(whole, WORD) - characters_of(F.col("_cleaned"), WORD)
            ).otherwise(F.lit(0).cast("long")),
        }
    )
    n_words, chars, repeats = (F.col("_counts")[c] for c in ("n_words", "word_chars", "n_repeat_words"))
    failed = (n_words < rules.least_words) | (100 * repeats > rules.most_repeat_percent * n_words)
    enough = F.col("_lost") <= chars * F.lit(rules.most_lost_share)
    quality = F.struct(
        n_words.alias("n_words"),
        chars.alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"),
        F.col("_n_dup_lines").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.col("_lost").alias("lost_chars"),
        (~failed & enough).alias("kept"),
        F.coalesce(F.col("_cleaned"), whole).alias("cleaned"),
    )
    return staged.select("row.*", quality.alias("quality"))


def clean(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text") -> DataFrame:
    """Documents that pass, without the lines that fail; the columns of the input."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(f"`{text}`").alias("text"))
    judged = assess(rows, rules).filter(F.col("quality.kept"))
    changes = {text: F.col("quality.cleaned"), "n_chars": F.length(F.col("quality.cleaned")).cast("long")}
    return judged.select(*[changes.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])
