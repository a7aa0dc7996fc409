"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.llm import alignment, bpe, decontaminate, html_text, licenses, multiset_hash, near_dup, pii, quality, spelling, substring, token_files, toxicity
from gablework.llm.oracles import ORACLES as ORACLES
from gablework.llm.shipping import ship
from gablework.sources.scratch import fresh_path
from gablework.sources.tables import table


def word_bpe() -> str:
    """The vocabulary file of the token queries; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    scanned = licenses.scan(table(spark, folder, "documents"))
    return scanned.select(
        "doc_id",
        *[F.col(f"licenses.{c}") for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join("licenses.base_labels", ",").alias("base_labels"),
        F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score",
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    train = docs.select("doc_id", "text").filter(~toxicity.held_out("doc_id")).join(labels.select("doc_id", "toxic"), "doc_id")
    model = toxicity.fit(train)
    scored = toxicity.score_rows(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# For trials on made-up data; a real run passes a key of its own.
TRIAL_KEY = b"trial key"


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    done = pii.pseudonymise(table(spark, folder, "documents"), TRIAL_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("pii.kind"))), ",")
    return done.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), kinds.alias("kinds"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return bpe.digest(table(spark, folder, "documents"), word_bpe())


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    extracted = html_text.extract(table(spark, folder, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return near_dup.assign(table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    path = fresh_path(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), path, word_bpe())
    return token_files.checksums(token_files.read_tokens(spark, path))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.assess(table(spark, folder, "documents"))
    return judged.selectExpr(
        "doc_id",
        "quality.n_words",
        "quality.word_chars",
        "quality.n_symbols",
        "quality.n_dup_lines",
        "quality.n_repeat_words",
        "quality.base_failed",
        "quality.kept",
        "quality.lost_chars",
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return substring.digest(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spelling.variants(spelling.count_words(table(spark, folder, "documents")))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    linked = alignment.linked(table(spark, folder, "documents"), byte_bpe(), piece_bpe())
    scored = alignment.corpus_scores(linked)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return multiset_hash.edits(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": op1_license_scans,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_bpe": op5_bpe,
    "op6_html_extraction": op6_html_extraction,
    "op7_near_dup": op7_near_dup,
    "op8_token_files": op8_token_files,
    "op9_quality_rules": op9_quality_rules,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_fingerprints": op13_fingerprints,
}
