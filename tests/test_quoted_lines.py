"""Files with quoted line breaks, read in many splits, against the reader that takes a file whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gablework.sources import quoted_lines as ql
from gablework.sources.delimited import Dialect, read_delimited, read_text

MULTI = Dialect(na_tokens=(), multi_line=True)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def unsplit(spark, path, sep=","):
    return spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=True).csv(path)


def same(a, b):
    return a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def made(seed, rows, end="\n", sep=","):
    """Values with quotes, separators and line breaks, some longer than a split."""
    rng = random.Random(seed)
    bits = ["a", "bc", sep, "\n", '"', "\n\n", "é", " ", '"\n"', "x" * 30, "\n" * 20]

    def value():
        if rng.random() < 0.5:
            return rng.choice(["", "1", "plain text", 'in"side', "7 inch\""])
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        return '"' + text.replace('"', '""') + '"'

    lines = [sep.join(["id", '"two\nlines"', "c"])]
    lines += [sep.join([str(i), value(), value()]) for i in range(rows)]
    return end.join(lines) + end


@pytest.mark.parametrize("size", [16, 64, 1_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_unsplit_read(spark, tmp_path, small_splits, size, end):
    for seed in (1,):
        path, plain = tmp_path / f"{seed}.csv", tmp_path / f"{seed}_plain.csv"
        path.write_text(made(seed, 60, end), newline="")
        # The other reader takes its line end from the first break, which may be one in quotes.
        plain.write_text(made(seed, 60), newline="")
        expected = unsplit(spark, str(plain))
        small_splits(size)
        found = read_text(spark, str(path), dialect=MULTI)
        assert size > 64 or ql.quoted_lines(spark, str(path), ",").select("split").distinct().count() > 20
        assert same(found, expected)


def test_several_files_and_another_separator(spark, tmp_path, small_splits):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text(made(10 + k, 30, sep=";"), newline="")
    expected = unsplit(spark, str(tmp_path), ";")
    small_splits(100)
    assert same(read_text(spark, str(tmp_path), dialect=Dialect(na_tokens=(), sep=";", multi_line=True)), expected)


def test_blank_lines_odd_ends_and_nothing(spark, tmp_path, small_splits):
    small_splits(9)
    body = 'a,b\n\n1,"x\n\ny"\n\n2,z'
    (tmp_path / "a.csv").write_text(body)
    assert sorted(map(tuple, read_text(spark, str(tmp_path / "a.csv"), dialect=MULTI).collect())) == [("1", "x\n\ny"), ("2", "z")]
    (tmp_path / "b.csv").write_text("a,b\n")
    empty = read_text(spark, str(tmp_path / "b.csv"), dialect=MULTI)
    assert empty.columns == ["a", "b"] and empty.count() == 0


def test_rows_of_another_width_are_errors(spark, tmp_path, small_splits):
    small_splits(12)
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2,"p\nq",3\n')
    with pytest.raises(Exception, match="not a row of 2 values"):
        read_text(spark, str(tmp_path / "a.csv"), dialect=MULTI).collect()
    cut = read_delimited(spark, str(tmp_path / "a.csv"), dialect=MULTI, on_bad="null")
    assert cut.count() == 2


def test_types_of_split_files(spark, tmp_path, small_splits):
    small_splits(40)
    rows = "".join(f'{i},"line\n{i}",{i / 4}\n' for i in range(50))
    (tmp_path / "a.csv").write_text("id,t,v\n" + rows)
    found = read_delimited(spark, str(tmp_path / "a.csv"), dialect=Dialect(multi_line=True))
    assert found.dtypes == [("id", "bigint"), ("t", "string"), ("v", "double")]
    assert found.agg(F.sum("id"), F.sum("v"), F.count_distinct("t")).first()[:] == (1225, 306.25, 50)


def test_what_reaches_the_driver_is_one_row_per_turning_split(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{i},"x\ny"\n' for i in range(2_000)))
    small_splits(1_000)
    lines = ql.quoted_lines(spark, str(tmp_path / "a.csv"), ",")
    assert ql.split_effects(lines).count() <= lines.select("split").distinct().count()
    assert read_text(spark, str(tmp_path / "a.csv"), dialect=MULTI).count() == 2_000
    assert "Exchange" not in lines.mapInArrow(ql._joined({}, (0,)), ql._SCHEMA)._jdf.queryExecution().executedPlan().toString()
