"""Delimited text scans.

Values are read as text, missing-value tokens become null, and each column is then cast
to its declared or inferred type. A declared type needs no extra pass over the file;
inference costs exactly one aggregate and looks at every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, StringType, StructField, StructType, TimestampType, _parse_datatype_string

from gablework.functions.missing import quoted
from gablework.functions.numbers import GROUPED_NUMBER
from gablework.sources.quoted_lines import records

# Tokens that pandas.read_csv takes as missing.
PANDAS_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Tokens that readr::read_csv takes as missing.
READR_NA = ("", "NA")

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_REAL = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI]nf(inity)?)\s*$"
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"  # what a cast would take as part of a number
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"
_TRUTH_LETTER = r"^(T|F|True|TRUE|true|False|FALSE|false)$"
_DATE = r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}$"
_DATETIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"
_TIME = r"^([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}(?:[.][0-9]+)?))?(?: ?([AaPp])[Mm])?$"


@dataclass(frozen=True)
class Dialect:
    na_tokens: Sequence[str] = PANDAS_NA
    sep: str = ","
    grouped_numbers: bool = False  # "1,234" is a number, as readr guesses
    dates: bool = False  # dates, times, date-times and the letters T and F are guessed too, as readr does
    multi_line: bool = False  # quoted line breaks; lines are put together first, in splits


PANDAS = Dialect()
READR = Dialect(na_tokens=READR_NA, grouped_numbers=True, dates=True)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    dialect: Dialect = PANDAS,
    on_bad: str = "error",
) -> DataFrame:
    """Scan delimited files with a header row.

    With ``schema`` the header is skipped and the schema's names are used. Without it the
    names come from the header and the types from the data. ``on_bad`` says what a value
    outside a declared type, or a row of another width than the header, does: ``"error"``, or ``"null"``
    (such a row is padded or cut). A quoted line break is such a row unless the dialect is ``multi_line``.
    Files of a list that differ in their headers are aligned by name.
    """
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    text = read_text(spark, path, schema.names if schema is not None else None, dialect, on_bad)
    return apply_types(text, infer_types(text, dialect) if schema is None else schema, dialect, on_bad)


def read_text(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str] | None = None,
    dialect: Dialect = PANDAS,
    on_bad: str = "error",
) -> DataFrame:
    """All columns as text, missing-value tokens already null.

    Files that belong together can be stacked as text and typed once for all of them.
    """
    if names is not None or isinstance(path, str):
        return _read_alike(spark, path, names, dialect, on_bad)
    # One scan per distinct header; reading a header reads one line.
    alike: dict[tuple[str, ...], list[str]] = {}
    for one in path:
        alike.setdefault(tuple(_reader(spark, dialect).csv(one).columns), []).append(one)
    parts = [_read_alike(spark, paths, header, dialect, on_bad) for header, paths in alike.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _reader(spark: SparkSession, dialect: Dialect) -> DataFrameReader:
    return spark.read.options(
        header=True, sep=dialect.sep, quote='"', escape='"', multiLine=dialect.multi_line, mode="PERMISSIVE"
    )


def _read_alike(
    spark: SparkSession, path: str | list[str], names: Sequence[str] | None, dialect: Dialect, on_bad: str
) -> DataFrame:
    reader = _reader(spark, dialect)
    if names is None:
        header = reader.csv(path).columns
        names = [n.removesuffix("\r") if dialect.multi_line else n for n in header]
    raw = "_unfit_row"
    while raw in names:
        raw = "_" + raw
    if dialect.multi_line:
        rows = _parse_records(records(spark, path, dialect.sep), names, raw, dialect)
    elif on_bad == "null":
        rows = reader.schema(StructType([StructField(n, StringType()) for n in names])).csv(path)
        return blank_tokens(rows, dialect.na_tokens)
    else:
        # The parser counts a row's values only when it keeps them all.
        reader = reader.options(columnNameOfCorruptRecord=raw, columnPruning=False)
        rows = reader.schema(StructType([StructField(n, StringType()) for n in [*names, raw]])).csv(path)
    if on_bad == "null":
        return blank_tokens(rows.drop(raw), dialect.na_tokens)
    # Spark refuses to read the unfit rows alone, so the message also names a value.
    told = F.concat(
        F.lit(f"not a row of {len(names)} values (a quoted line break needs multi_line=True): "),
        F.col(quoted(raw)),
        F.lit(f"; {names[0]}: "),
        F.coalesce(F.col(quoted(names[0])), F.lit("")),
    )
    fit = F.when(F.col(quoted(raw)).isNull(), True).otherwise(F.raise_error(told).cast("boolean"))
    return blank_tokens(rows.filter(fit).drop(raw), dialect.na_tokens)


def _parse_records(rows: DataFrame, names: Sequence[str], raw: str, dialect: Dialect) -> DataFrame:
    schema = ", ".join(f"{quoted(n)} STRING" for n in [*names, raw])
    options = {"sep": dialect.sep, "quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": raw}
    parsed = rows.select(F.from_csv("record", schema, {**options, "mode": "PERMISSIVE"}).alias("values"))
    return parsed.select("values.*")


def apply_types(
    text: DataFrame, schema: StructType, dialect: Dialect = PANDAS, on_bad: str = "error"
) -> DataFrame:
    return text.select(*[_typed(f, dialect, on_bad).alias(f.name) for f in schema])


def blank_tokens(text: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Null out missing-value tokens in every (text) column."""
    return text.select(
        *[F.when(~F.col(quoted(c)).isin(*tokens), F.col(quoted(c))).alias(c) for c in text.columns]
    )


# What a column may be, narrowest first, with the dialect's say; it is the first that all its values are.
# A time of day is seconds since midnight, in double, as readr's own class stores it.
_TIME_OF_DAY = {"time_of_day": True}
_LADDER = ("truth", "whole", "real", "grouped", "time", "date", "datetime")
_KINDS = {
    "truth": "boolean",
    "whole": "bigint",
    "real": "double",
    "grouped": "double",
    "time": "double",
    "date": "date",
    "datetime": "timestamp",
}


def _fits(value: Column, dialect: Dialect) -> dict[str, Column]:
    """Whether a value is of each kind."""
    real = value.rlike(_REAL)
    kinds = {
        "truth": (F.length(value) <= 5) & value.rlike(_TRUTH_LETTER if dialect.dates else _TRUTH),
        "whole": value.rlike(_WHOLE) & value.try_cast("long").isNotNull(),
        "real": real,
    }
    if dialect.grouped_numbers:
        kinds["grouped"] = real | value.rlike(GROUPED_NUMBER)
    if dialect.dates:
        # Cheap tests come first, so that few values meet the patterns.
        day = F.length(value).between(8, 10) & value.rlike(_DATE) & _as_date(value).isNotNull()
        kinds["time"] = value.contains(":") & _seconds(value).isNotNull()
        kinds["date"] = day
        kinds["datetime"] = day | (value.contains(":") & value.rlike(_DATETIME) & _as_moment(value).isNotNull())
    return kinds


def _as_date(text: Column) -> Column:
    return F.regexp_replace(text, "/", "-").try_cast("date")


def _as_moment(text: Column) -> Column:
    """A date or date-time; without a zone it is in the session's. Seconds and the zone's colon may be left out."""
    spelled = F.regexp_replace(text, r"^(.{10}[ T].{5})(Z|[+-].*)?$", "$1:00$2")
    return F.regexp_replace(spelled, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2").try_cast("timestamp")


def _seconds(text: Column) -> Column:
    """Seconds since midnight of a time on a 24-hour or, with am or pm, a 12-hour clock."""
    # A cast of empty text to double is an exception inside, and slow.
    parts = [F.regexp_extract(text, _TIME, i) for i in (1, 2, 3)]
    hour, minute, second = (F.when(part != "", part).try_cast("double") for part in parts)
    half = F.lower(F.regexp_extract(text, _TIME, 4))
    known = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.coalesce(second, F.lit(0.0))
    clock = F.when((known < 24) & (minute < 60) & (second < 60), known * 3600 + minute * 60 + second)
    return F.when(text.rlike(_TIME), clock)


def infer_types(text: DataFrame, dialect: Dialect = PANDAS) -> StructType:
    """Narrowest type that fits every non-null value; one aggregate for all columns."""
    checks = []
    for i, name in enumerate(text.columns):
        value = F.col(quoted(name))
        checks.append(F.count(value).alias(f"n{i}"))
        checks += [F.count_if(fits).alias(f"{kind}{i}") for kind, fits in _fits(value, dialect).items()]
    seen = text.agg(*checks).first().asDict()

    def pick(i: int, name: str) -> StructField:
        n = seen[f"n{i}"]
        if n == 0:
            return StructField(name, DoubleType())
        found = next((kind for kind in _LADDER if seen.get(f"{kind}{i}") == n), None)
        dtype = StringType() if found is None else _parse_datatype_string(_KINDS[found])
        return StructField(name, dtype, True, _TIME_OF_DAY if found == "time" else None)

    return StructType([pick(i, name) for i, name in enumerate(text.columns)])


def _typed(field: StructField, dialect: Dialect, on_bad: str) -> Column:
    text = F.col(quoted(field.name))
    if isinstance(field.dataType, StringType):
        return text
    body = text
    if dialect.grouped_numbers and field.dataType.typeName() in ("double", "float", "long", "integer"):
        body = F.when(text.rlike(GROUPED_NUMBER), F.regexp_replace(text, ",", "")).otherwise(text)
    if field.dataType.typeName() in ("double", "float"):
        body = F.when(~body.rlike(_JAVA_SUFFIX), body)
    if field.metadata == _TIME_OF_DAY:
        value = _seconds(text)
    elif isinstance(field.dataType, DateType):
        value = _as_date(text)
    elif isinstance(field.dataType, TimestampType):
        value = F.when(text.rlike(_DATE), _as_date(text).cast("timestamp")).otherwise(_as_moment(text))
    else:
        value = body.try_cast(field.dataType)
    if on_bad == "null":
        return value
    return F.when(text.isNotNull() & value.isNull(), _complain(field.name, text, field.dataType)).otherwise(value)


def _complain(name: str, text: Column, dtype: DataType) -> Column:
    message = F.concat(F.lit(f"column {name}: not a {dtype.simpleString()}: "), text)
    return F.raise_error(message).cast(dtype)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.options(header=True, sep=sep, quote='"', escape='"', emptyValue="", nullValue="").csv(path)
    return path
