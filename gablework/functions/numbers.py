"""Numbers written for people: currency signs, thousands marks, open-ended counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes accepted once sign and currency mark are read and outer blanks are gone.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
GROUPED_NUMBER = r"^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]*)?$"


# One sign and one currency mark before the number, in either order, one mark after it.
_AROUND = r"^\s*(?:([+-])\s*[$€£]?|[$€£]\s*([+-]?)|)\s*(.*?)\s*[$€£]?\s*$"


def _bare_text(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), _AROUND, "$1$2$3")


def parse_number_text(text: Column, dtype: str = "double") -> Column:
    """``"$409,900"`` -> 409900, ``"2.5+"`` -> 2.5; anything else is null."""
    body = F.regexp_replace(_bare_text(text), r"\+$", "")
    number = F.when(body.rlike(GROUPED_NUMBER), F.regexp_replace(body, ",", "")).when(
        body.rlike(PLAIN_NUMBER), body
    )
    return number.try_cast(dtype)


def is_open_ended(text: Column) -> Column:
    """True for counts such as ``"2.5+"`` ("this many or more"), false for other text, null for none."""
    marked = _bare_text(text).endswith("+") & parse_number_text(text).isNotNull()
    return F.when(text.isNotNull(), marked)
