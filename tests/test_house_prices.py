"""The whole house-price job on invented rows, against plain Python."""

from __future__ import annotations

import csv
import random
import statistics

import pytest
from pyspark.errors import SparkRuntimeException

from gablework.operators.split import hash_split
from gablework.plans import house_prices as hp
from gablework.plans import recipes as rc

TEXT = [*hp.CARRIED_FORWARD, "Street", "Neighborhood"]
NUMBERS = sorted(
    {source for _, _, source in hp.MODEL_COLUMNS}
    - {"Neighborhood", "TotalArea", "Bathrooms", "YearAverage", "PrecioVenta"}
) + ["TotalBsmtSF", "GarageArea", "1stFlrSF", "2ndFlrSF", "GrLivArea", "FullBath", "HalfBath", "YearRemodAdd", "YearBuilt"]
HOLES = set(hp.ZERO_MEANS_ABSENT + hp.MEAN_FILLED + hp.MEDIAN_FILLED + hp.CARRIED_FORWARD + ["Street"])


def invent(first_id: int, count: int, seed: int) -> list[dict]:
    dice = random.Random(seed)
    rows = []
    for offset in range(count):
        row = {"Id": first_id + offset, "Alley": "Pave" if dice.random() < 0.3 else None}
        row |= {c: dice.randint(1, 60) for c in NUMBERS}
        row |= {c: dice.choice(["Ab", "Cd", "Ef"]) for c in TEXT}
        row["Neighborhood"] = dice.choice(hp.NEIGHBORHOODS)
        for c in HOLES:
            if dice.random() < 0.1:
                row[c] = None
        row["SalePrice"] = 1000 * row["OverallQual"] + 100 * row["GrLivArea"] + dice.randint(0, 500)
        rows.append(row)
    return rows


def save(path, rows, columns):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(columns)
        writer.writerows([["NA" if r[c] is None else r[c] for c in columns] for r in rows])
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("houses")
    train, test = invent(1, 300, 1), invent(301, 120, 2)
    train[0]["Electrical"] = None  # nothing before it to carry
    train[0]["MSZoning"] = None
    random.Random(3).shuffle(train)
    columns = [c for c in train[0] if c != "SalePrice"]
    return {
        "train": save(folder / "train.csv", train, [*columns, "SalePrice"]),
        "test": save(folder / "test.csv", test, columns),
        "target": save(folder / "target.csv", test, ["Id", "SalePrice"]),
        "rows": sorted(train, key=lambda r: r["Id"]) + test,
    }


@pytest.fixture(scope="module")
def loaded(spark, files):
    return hp.load_houses(spark, files["train"], files["test"], files["target"])


def test_both_files_are_stacked_with_targets(loaded, files):
    assert loaded.count() == 420
    assert dict(loaded.dtypes)["SalePrice"] == "bigint"
    assert loaded.filter("SalePrice IS NULL").count() == 0
    assert {r["source"]: r["count"] for r in loaded.groupBy("source").count().collect()} == {"train": 300, "test": 120}


def test_cleaning_matches_plain_python(loaded, files):
    clean = {r["Id"]: r for r in hp.clean_houses(loaded).collect()}
    rows = files["rows"]
    mean = statistics.fmean(r["LotFrontage"] for r in rows if r["LotFrontage"] is not None)
    median = statistics.median(r["GarageYrBlt"] for r in rows if r["GarageYrBlt"] is not None)
    carried = dict.fromkeys(hp.CARRIED_FORWARD)
    assert "Alley" not in clean[1].__fields__
    for row in rows:
        found = clean[row["Id"]]
        for c in hp.CARRIED_FORWARD:
            carried[c] = row[c] if row[c] is not None else carried[c]
            assert found[c] == (carried[c] or "None")
        assert found["Street"] == (row["Street"] or "None")
        assert found["LotFrontage"] == pytest.approx(mean if row["LotFrontage"] is None else row["LotFrontage"])
        assert found["GarageYrBlt"] == (median if row["GarageYrBlt"] is None else row["GarageYrBlt"])
        assert found["GarageCars"] == (row["GarageCars"] or 0)
        assert found["TotalArea"] == sum(row[c] or 0 for c in hp.AREAS)
        assert found["Bathrooms"] == row["FullBath"] + row["HalfBath"] * 0.5
        assert found["YearAverage"] == (row["YearRemodAdd"] + row["YearBuilt"]) / 2
        assert found["PrecioVenta"] == row["SalePrice"]
    assert not set(hp.REPLACED) & set(clean[1].__fields__)


def test_fit_scope_keeps_test_rows_out(loaded, files):
    train = [r["LotFrontage"] for r in files["rows"][:300] if r["LotFrontage"] is not None]
    hole = next(r["Id"] for r in files["rows"] if r["LotFrontage"] is None)
    found = hp.clean_houses(loaded, fit_scope="train").filter(f"Id = {hole}").first()["LotFrontage"]
    assert found == pytest.approx(statistics.fmean(train))


def test_model_table_has_the_declared_schema(loaded, files):
    clean = hp.clean_houses(loaded)
    table = hp.model_table(hp.encode_neighborhood(clean), narrow=True, check=True)
    schema, _ = hp.model_schema(narrow=True)
    assert len(schema) == 32
    assert [f.dataType.simpleString() for f in schema].count("int") == 19
    assert [(f.name, f.dataType, f.nullable) for f in table.schema][2:] == [
        (f.name, f.dataType, False) for f in schema
    ]
    codes = {r["Id"]: r["Barrio"] for r in table.select("Id", "Barrio").collect()}
    for row in files["rows"]:
        assert hp.NEIGHBORHOODS[codes[row["Id"]] - 1] == row["Neighborhood"]


def test_learned_codes_follow_the_mean_price(loaded, files):
    coded = hp.encode_neighborhood(hp.clean_houses(loaded), learned=True).select("Id", "Neighborhood").collect()
    prices: dict[str, list] = {}
    for row in files["rows"]:
        prices.setdefault(row["Neighborhood"], []).append(row["SalePrice"])
    ranked = sorted(prices, key=lambda n: (statistics.fmean(prices[n]), n))
    code = {r["Id"]: r["Neighborhood"] for r in coded}
    assert all(ranked[code[r["Id"]] - 1] == r["Neighborhood"] for r in files["rows"])


def test_unknown_neighborhood_stops_the_job(loaded):
    from pyspark.sql import functions as F

    renamed = hp.clean_houses(loaded).withColumn("Neighborhood", F.lit("Elsewhere"))
    with pytest.raises(SparkRuntimeException, match="Barrio may not be"):
        hp.model_table(hp.encode_neighborhood(renamed)).collect()


def test_prepared_table_trains_every_recipe_input(spark, files):
    table = hp.prepare_houses(spark, files["train"], files["test"], files["target"])
    inputs = hp.house_inputs(table, top=16, components=9)
    assert len(inputs.columns) == 31
    train, test = hash_split(table, ["Id"])
    train = rc.stable_rows(train, partitions=2)
    spread = test.selectExpr(f"stddev_pop({hp.LABEL})").first()[0]
    from gablework.operators.evaluate import rmse

    for name in ("forest", "forest_standardized", "forest_selected"):
        model = rc.fit_recipe(rc.RECIPES[name](inputs), train)
        assert model.transform(test).agg(rmse(hp.LABEL)).first()[0] < spread



def test_padded_keys_meet_and_sparse_columns_are_learned_on_the_scope(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    train = put("train.csv", "Id,v,SalePrice\n3,1,30\n4,2,40\n")
    test = put("test.csv", "Id,v\n01,NA\n 2,NA\n")
    target = put("target.csv", "Id,SalePrice\n1,10\n2,20\n")
    rows = hp.load_houses(spark, train, test, target).orderBy("Id").collect()
    assert [(r["Id"], r["SalePrice"]) for r in rows] == [(1, 10), (2, 20), (3, 30), (4, 40)]
    seen = hp.load_houses(spark, train, test, target)
    assert "v" in hp.observed_columns(seen, "train").columns and "v" not in hp.observed_columns(seen, "all").columns
