"""The cleaning chain over the documents table, from two sources to a model-ready table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from gablework.operators.combine import stack
from gablework.operators.encode import encode_mapping, fit_target_order
from gablework.operators.impute import fill_along, fill_literal, fill_zero, fit_fills
from gablework.operators.shape import conform_schema, derive, drop_sparse, select_numeric
from gablework.sources.scratch import materialize
from gablework.sources.tables import table

GRADE_CODES = {"None": 0, "low": 1, "high": 2}

CLEAN_SCHEMA = (
    "source_rank INT NOT NULL, doc_id BIGINT NOT NULL, length DOUBLE NOT NULL, toxic INT NOT NULL, "
    "quality DOUBLE NOT NULL, grade_code INT NOT NULL, source_code INT NOT NULL, weight DOUBLE NOT NULL"
)


def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, English ones first, with labels attached, filled, derived, encoded."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    english = documents.filter(F.col("lang") == "en")
    others = documents.filter(F.col("lang") != "en")
    stacked = stack({"english": english, "others": others}, origin="part").join(labels, "doc_id", "left")
    graded = stacked.withColumns(
        {
            "grade": F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low"),
            # Only toxic rows carry a note: sparse, so the first rule removes it.
            "note": F.when(F.col("toxic") == 1, "flagged"),
        }
    )
    # Several statistics are fitted below; written out once, each reads its own columns only.
    rows = materialize(graded, "documents")

    kept = drop_sparse(rows, min_share=0.3)
    quality = fit_fills(kept, mean=["quality"])
    sources = fit_target_order(kept, "source", "n_chars")
    filled = quality.apply(fill_zero(kept, ["toxic"]))
    complete = fill_literal(fill_along(filled, ["grade"], ["source_rank", "doc_id"]))
    derived = derive(
        complete,
        {"weight": F.col("n_chars") * 0.5 + F.col("toxic") * 100, "length": F.col("n_chars").cast("double")},
    )
    graded_code = encode_mapping(derived, "grade", GRADE_CODES, "grade_code", on_unmapped="error")
    coded = sources.apply(graded_code, "source_code")
    return conform_schema(select_numeric(coded), _parse_datatype_string(CLEAN_SCHEMA))
