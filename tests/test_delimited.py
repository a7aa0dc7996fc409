from __future__ import annotations

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from gablework.functions.numbers import is_open_ended, parse_number_text
from gablework.sources.delimited import PANDAS, READR, Dialect, read_delimited, write_delimited
from gablework.sources.scratch import fresh_path, materialize, shared_folder


@pytest.fixture
def write(tmp_path):
    def _write(text: str, name: str = "data.csv") -> str:
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return _write


def test_types_are_inferred_from_all_rows(spark, write):
    path = write("Id,a,b,c,d,e,f\n1,7,1.5,x,True,,2020-01-01\n2,NA,2,N/A,FALSE,null,2020-01-02\n3,-8,1e3,'y',true,,\n")
    df = read_delimited(spark, path)
    assert df.dtypes == [
        ("Id", "bigint"),
        ("a", "bigint"),
        ("b", "double"),
        ("c", "string"),
        ("d", "boolean"),
        ("e", "double"),
        ("f", "string"),
    ]
    assert tuple(df.orderBy("Id").collect()[1]) == (2, None, 2.0, None, False, None, "2020-01-02")


def test_a_late_value_decides_the_type(spark, write):
    body = "\n".join(["x"] + ["1"] * 500 + ["1.5"])
    assert read_delimited(spark, write(body + "\n")).dtypes == [("x", "double")]
    assert read_delimited(spark, write(body + "\n12a\n", "other.csv")).dtypes == [("x", "string")]


def test_numbers_beyond_long_are_doubles(spark, write):
    assert read_delimited(spark, write("x\n99999999999999999999\n1\n")).dtypes == [("x", "double")]


def test_java_number_suffixes_are_text(spark, write):
    assert read_delimited(spark, write("x\n1d\n2f\n")).dtypes == [("x", "string")]


def test_declared_names_win_over_the_header(spark, write):
    df = read_delimited(spark, write("foo,bar\n1,2.5\n2,\n"), schema="Id int, SalePrice double")
    assert [tuple(r) for r in df.orderBy("Id").collect()] == [(1, 2.5), (2, None)]


def test_values_outside_a_declared_type(spark, write):
    path = write("Id,v\n1,abc\n")
    with pytest.raises(SparkRuntimeException, match="column v: not a int: abc"):
        read_delimited(spark, path, schema="Id int, v int").collect()
    assert read_delimited(spark, path, schema="Id int, v int", on_bad="null").first()["v"] is None


def test_java_suffixes_do_not_fit_a_declared_double(spark, write):
    path = write("v\n12d\n12f\n1.5\nInf\n")
    with pytest.raises(SparkRuntimeException, match="not a double: 12[df]"):
        read_delimited(spark, path, schema="v double").collect()
    found = [r["v"] for r in read_delimited(spark, path, schema="v double", on_bad="null").collect()]
    assert found == [None, None, 1.5, float("inf")]


@pytest.mark.parametrize("body", ["1,2\n2,3,99\n", "1,2\n3\n", '1,"x\ny"\n2,z\n'])
@pytest.mark.parametrize("schema", [None, "a int, b string"])
def test_rows_of_another_width_are_errors(spark, write, body, schema):
    path = write("a,b\n" + body)
    with pytest.raises(SparkRuntimeException, match="not a row of 2 values"):
        read_delimited(spark, path, schema=schema).collect()
    with pytest.raises(SparkRuntimeException, match="not a row of 2 values"):
        read_delimited(spark, path, schema=schema).select("a").collect()
    assert read_delimited(spark, path, schema="a string, b string", on_bad="null").count() >= 2


def test_quoted_line_breaks_are_one_value(spark, write):
    path = write('a,b\n1,"x\ny"\n2,z\n')
    rows = read_delimited(spark, path, dialect=Dialect(multi_line=True)).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "x\ny"), (2, "z")]


def test_files_of_a_list_meet_by_name(spark, write):
    paths = [write("x,y\n1,2\n"), write("y,x\n20,10\n", "b.csv"), write("x,y\n3,4\n", "c.csv")]
    df = read_delimited(spark, paths)
    assert df.columns == ["x", "y"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (3, 4), (10, 20)]


def test_quotes_and_separators(spark, write):
    path = write('a;b\n"x; ""y""";1\nz;2\n')
    rows = read_delimited(spark, path, dialect=Dialect(sep=";")).orderBy("b").collect()
    assert [tuple(r) for r in rows] == [('x; "y"', 1), ("z", 2)]
    assert len(read_delimited(spark, path).columns) == 1


def test_repeated_rows_stay(spark, write):
    assert read_delimited(spark, write("a,b\n1,2\n1,2\n1,2\n")).count() == 3


def test_dialects_differ_in_missing_tokens_and_grouping(spark, write):
    path = write('a,b\n"1,234",None\n7,NA\n')
    assert read_delimited(spark, path, dialect=PANDAS).dtypes == [("a", "string"), ("b", "double")]
    readr = read_delimited(spark, path, dialect=READR)
    assert readr.dtypes == [("a", "double"), ("b", "string")]
    assert sorted((r["a"], r["b"]) for r in readr.collect()) == [(7.0, None), (1234.0, "None")]


def test_number_text(spark):
    texts = ["$409,900", "1,234", "2.5+", "2", "-$1,200.50", "1e3", ".5", "", "n/a", "1,23", "12+3", "+", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(parse_number_text(F.col("t")).alias("v"), is_open_ended(F.col("t")).alias("plus")).collect()
    assert [r["v"] for r in found] == [
        409900.0, 1234.0, 2.5, 2.0, -1200.5, 1000.0, 0.5, None, None, None, None, None, None,
    ]
    assert [r["plus"] for r in found] == [False] * 2 + [True] + [False] * 9 + [None]


def test_separate_numbers_are_no_number(spark):
    texts = ["12 34", "$1 $2", "1-2", " $ -5 ", "-$5", "5 €", "+ 5", "$$5", "--5", "5\n6"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r["v"] for r in df.select(parse_number_text(F.col("t")).alias("v")).collect()]
    assert found == [None, None, None, -5.0, -5.0, 5.0, 5.0, None, None, None]


def test_written_frames_are_read_back(spark, write):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], "id int, v string")
    path = write_delimited(df, fresh_path(spark, "test"))
    back = read_delimited(spark, path, schema="id int, v string")
    assert back.exceptAll(df).count() == 0 and back.count() == 2
    assert path.startswith(shared_folder(spark))


def test_materialized_frames_have_no_lineage(spark):
    df = materialize(spark.range(5).withColumn("x", F.col("id") * 2), "test")
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.agg(F.sum("x")).first()[0] == 20


def test_readr_types(spark, write):
    path = write(
        "l,l2,d,t,dt,mixed,n,bad,tf\n"
        "T,true,2020-02-29,1:05,2020-01-01T10:30:00Z,2020-01-01,1,2020-02-30,T\n"
        "F,FALSE,2021/3/5,12:00 AM,2020-01-01 10:30:15.5,2020-01-01 01:00,2.5,2020-01-01,F\n"
        "NA,NA,NA,11:59:59.5 pm,2020-01-01T10:30+02:00,,,NA,x\n"
    )
    df = read_delimited(spark, path, dialect=READR)
    assert [t for _, t in df.dtypes] == [
        "boolean", "boolean", "date", "double", "timestamp", "timestamp", "double", "string", "string",
    ]
    rows = df.select("l", "l2", "d", "t", F.unix_micros("dt").alias("dt")).collect()
    assert [r.l for r in rows] == [True, False, None] and [r.l2 for r in rows] == [True, False, None]
    assert [str(r.d) for r in rows] == ["2020-02-29", "2021-03-05", "None"]
    assert [r.t for r in rows] == [3900.0, 0.0, 86399.5]
    base = 1577836800_000_000
    assert [r.dt - base for r in rows] == [37_800_000_000, 37_815_500_000, 30_600_000_000]
    assert [t for _, t in read_delimited(spark, path).dtypes] == ["string", "boolean"] + ["string"] * 4 + ["double", "string", "string"]


def test_times_must_be_on_the_clock(spark, write):
    assert read_delimited(spark, write("t\n24:00\n"), dialect=READR).dtypes == [("t", "string")]
    assert read_delimited(spark, write("t\n13:00 pm\n", "b.csv"), dialect=READR).dtypes == [("t", "string")]
    assert read_delimited(spark, write("t\n0:60\n", "c.csv"), dialect=READR).dtypes == [("t", "string")]
