from __future__ import annotations

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from gablework.operators import encode
from gablework.operators.combine import DuplicateKeys, attach_target, stack
from gablework.operators.encode import encode_mapping, fit_target_order
from gablework.operators.histogram import histogram, round_classes
from gablework.operators.profile import (
    CompletenessGate,
    IncompleteData,
    group_mean,
    null_counts,
    null_profile,
    require_complete,
    sparse_columns,
)
from gablework.operators.shape import (
    conform_by_position,
    conform_schema,
    drop_sparse,
    feature_columns,
    select_numeric,
)
from gablework.operators.split import hash_split, with_fold


@pytest.fixture(scope="module")
def holes(spark):
    """Ten rows: ``full`` complete, ``edge`` at exactly 80 %, ``thin`` below, ``none`` empty."""
    rows = [
        (i, None if i < 2 else i, None if i < 3 else "x", None, float("nan") if i == 0 else 1.0) for i in range(10)
    ]
    return spark.createDataFrame(rows, "full int, edge int, thin string, none double, nans double")


def test_sparse_threshold_keeps_its_own_share(holes):
    assert sparse_columns(holes) == ["thin", "none"]
    assert drop_sparse(holes).columns == ["full", "edge", "nans"]


def test_null_profile_is_ascending_without_complete_columns(holes):
    rows = [(r["column_name"], round(r["pct_missing"], 6)) for r in null_profile(holes).collect()]
    assert rows == [("nans", 10.0), ("edge", 20.0), ("thin", 30.0), ("none", 100.0)]


def test_null_counts_top(holes):
    assert [tuple(r) for r in null_counts(holes, 2).collect()] == [("none", 10), ("thin", 3)]


def test_gate_names_the_columns(holes):
    assert sorted(map(str, require_complete(holes, ["full"]).collect())) == sorted(map(str, holes.collect()))
    with pytest.raises(IncompleteData, match="edge: 2.*none: 10"):
        require_complete(holes)


def test_gate_counts_while_rows_flow(holes, spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    gate = CompletenessGate(holes.mapInArrow(counted, holes.schema))
    assert gate.frame.collect() and reads.value == holes.count()
    assert gate.missing() == {"edge": 2, "thin": 3, "none": 10, "nans": 1}
    with pytest.raises(IncompleteData, match="thin: 3"):
        gate.check()
    assert reads.value == holes.count()


def test_profile_is_one_aggregate(holes):
    plan = null_profile(holes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_select_by_type_and_exclusion(holes):
    assert select_numeric(holes).columns == ["full", "edge", "none", "nans"]
    assert feature_columns(holes, "edge", ["thin"]) == ["full", "none", "nans"]


def test_group_mean_drops_missing_keys_and_orders(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), (None, 9.0), ("a", None), ("c", 1.0)], "k string, v double")
    assert [tuple(r) for r in group_mean(df, "k", "v").collect()] == [("b", 1.0), ("c", 1.0), ("a", 3.0)]


def test_conform_declares_and_enforces_non_null(spark):
    schema = _parse_datatype_string("b DOUBLE NOT NULL, a INT")
    df = spark.createDataFrame([("7", 1.5), ("8", 2.5)], "x string, y double")
    out = conform_schema(df, schema, {"a": "x", "b": "y"})
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in out.schema] == [
        ("b", "double", False),
        ("a", "int", True),
    ]
    assert [tuple(r) for r in out.collect()] == [(1.5, 7), (2.5, 8)]
    bad = spark.createDataFrame([("7", None)], "x string, y double")
    with pytest.raises(SparkRuntimeException, match="may not be"):
        conform_schema(bad, schema, {"a": "x", "b": "y"}).collect()
    with pytest.raises(ValueError, match="no source column for b"):
        conform_schema(df, schema, {"a": "x"})


def test_conform_by_position_counts_columns(spark):
    schema = _parse_datatype_string("p INT, q DOUBLE")
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert conform_by_position(df, schema).dtypes == [("p", "int"), ("q", "double")]
    with pytest.raises(ValueError, match="1 columns"):
        conform_by_position(df.select("a"), schema)


def test_attach_target_keeps_both_sides(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "id int, t double")
    assert sorted(map(tuple, attach_target(a, b, "id").collect())) == [(1, "x", None), (2, "y", 5.0), (3, None, 6.0)]


def test_attach_target_rejects_repeated_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    b = spark.createDataFrame([(1, 5.0)], "id int, t double")
    with pytest.raises(DuplicateKeys, match="id = 1 occurs 2 times in features"):
        attach_target(a, b, "id")
    with pytest.raises(DuplicateKeys, match="target"):
        attach_target(b, a, "id")


def test_stack_fills_absent_columns_and_keeps_origin(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, 5.0)], "id int, t double")
    rows = [r.asDict() for r in stack({"first": a, "second": b}).orderBy("source_rank").collect()]
    assert rows == [
        {"id": 1, "v": "x", "source": "first", "source_rank": 0, "t": None},
        {"id": 2, "v": None, "source": "second", "source_rank": 1, "t": 5.0},
    ]


@pytest.fixture(scope="module")
def priced(spark):
    rows = [("b", 2.0), ("b", 4.0), ("a", 3.0), ("c", 1.0), (None, 7.0), ("d", None)]
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("small", [True, False])
def test_target_order_breaks_ties_by_name(priced, monkeypatch, small):
    if not small:
        monkeypatch.setattr(encode, "BROADCAST_ROWS", 2)
    order = fit_target_order(priced, "k", "v")
    assert order.small is small
    assert sorted((r["category"], r["code"]) for r in order.table.collect()) == [("a", 2), ("b", 3), ("c", 1), ("d", 4)]
    coded = {r["k"]: r["k_code"] for r in order.apply(priced, "k_code").collect()}
    assert coded == {"a": 2, "b": 3, "c": 1, "d": 4, None: None}


def test_both_lookup_paths_give_equal_codes(spark):
    rows = [("zz", float("inf")), ("aa", None), ("bb", 1.0), ("cc", 1.0), ("dd", float("-inf")), ("ee", -2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    small, large = fit_target_order(df, "k", "v"), fit_target_order(df, "k", "v", most_broadcast=2)
    assert (small.small, large.small) == (True, False)
    assert dict(small.table.dtypes)["code"] == dict(large.table.dtypes)["code"] == "int"
    codes = [{r["category"]: r["code"] for r in o.table.collect()} for o in (small, large)]
    assert codes[0] == codes[1] == {"dd": 1, "ee": 2, "bb": 3, "cc": 4, "zz": 5, "aa": 6}


def test_mapping_keys_of_other_types(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    assert [r["k"] for r in encode_mapping(df, "k", {1: 10, 2: 20}).collect()] == [10, 20, None]


def test_histogram_leaves_infinite_values_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("-inf"),)], "v double")
    assert sum(r["n"] if "n" in r else r["count"] for r in (x.asDict() for x in histogram(df, "v", width=1.0).collect())) == 2


def test_broadcast_only_for_measured_small_lookups(priced, monkeypatch):
    def plan():
        frame = fit_target_order(priced, "k", "v").apply(priced)
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(encode, "LONGEST_NAME", 0)
    assert "strategy=merge" in plan()


def test_a_hot_category_is_spread_over_the_tasks_of_a_large_lookup(spark):
    hot = F.when(F.col("id") % 10 < 6, "c7").when(F.col("id") % 50 == 9, None)
    df = spark.range(0, 100_000, 1, 8).select("id", hot.otherwise(F.concat(F.lit("c"), F.col("id"))).alias("k"))
    lookup = spark.range(50_000).select(F.concat(F.lit("c"), F.col("id")).alias("category"), F.col("id").cast("int").alias("code"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {n: spark.conf.get(n) for n in settings}
    try:
        for n, v in settings.items():
            spark.conf.set(n, v)
        found = encode._look_up_large(df, "k", lookup, "code", "null")
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) <= 2 * sum(tasks) / len(tasks) and sum(tasks) == 100_000
        wrong = found.filter("NOT (code <=> CASE WHEN int(substr(k, 2)) < 50000 THEN int(substr(k, 2)) END)")
        assert wrong.count() == 0
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_lookups_keep_columns_of_their_own_names(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, 2, 3), ("b", 4, 5, 6)], "k string, _code int, _category int, _hot int")
    for limit in (10, 0):
        monkeypatch.setattr(encode, "BROADCAST_ROWS", limit)
        rows = encode_mapping(df, "k", {"a": 10}, "c").orderBy("k").collect()
        assert [tuple(r) for r in rows] == [("a", 1, 2, 3, 10), ("b", 4, 5, 6, None)]


def test_unmapped_categories(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    codes = {"a": 1}
    assert [r["k"] for r in encode_mapping(df, "k", codes).collect()] == [1, None, None]
    assert [r["k"] for r in encode_mapping(df, "k", codes, on_unmapped=0).collect()] == [1, 0, None]
    with pytest.raises(SparkRuntimeException, match="without a code: zz"):
        encode_mapping(df, "k", codes, on_unmapped="error").collect()


def test_split_is_disjoint_complete_and_partition_free(spark):
    df = spark.range(20_000)
    parts = [hash_split(frame, ["id"]) for frame in (df.repartition(1), df.repartition(13, "id"))]
    for train, test in parts:
        assert train.count() + test.count() == 20_000
        assert train.join(test, "id").count() == 0
        assert 0.68 < train.count() / 20_000 < 0.72
    assert parts[0][0].exceptAll(parts[1][0]).count() == 0


def test_three_way_split(spark):
    df = spark.range(9_000)
    sizes = [p.count() for p in hash_split(df, ["id"], [2, 1, 1], seed=1)]
    assert sum(sizes) == 9_000
    assert 0.47 < sizes[0] / 9_000 < 0.53


def test_folds_are_balanced_and_not_the_split(spark):
    train, _ = hash_split(spark.range(30_000), ["id"])
    counts = with_fold(train, ["id"], 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == [0, 1, 2]
    assert max(r["count"] for r in counts) / min(r["count"] for r in counts) < 1.05


@pytest.mark.parametrize(
    "low,high,wanted,expected",
    [
        (0.1, 2.5, 9, (0.0, 0.2, 13)),  # the petal widths of a well-known table
        (1.0, 50.0, 17, (0.0, 5.0, 10)),
        (0.0, 100.0, 5, (0.0, 20.0, 5)),
        (3.0, 3.0, 4, (3.0, 1.0, 1)),
    ],
)
def test_round_classes(low, high, wanted, expected):
    assert round_classes(low, high, wanted) == pytest.approx(expected)


def test_histogram_is_right_closed_and_lists_empty_classes(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.2, 0.30000000000000004, 0.9, None)], "x double")
    rows = histogram(df, "x", width=0.1, start=0.0).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 1, 1, 0, 0, 0, 0, 0, 1]
    assert sum(r["n"] for r in rows) == 5
    with pytest.raises(ValueError, match="no values"):
        histogram(df.filter(F.col("x").isNull()), "x")
