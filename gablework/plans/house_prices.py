"""House-sale files to a modelling table: load, clean, encode, conform.

Statistics can be learned from all rows (``fit_scope="all"``, as published) or from the
training file only (``"train"``), which keeps hold-out rows out of the fitted values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from gablework.operators.combine import attach_target, stack
from gablework.operators.encode import encode_mapping, fit_target_order
from gablework.operators.impute import fill_along, fill_literal, fill_zero, fit_fills
from gablework.operators.profile import require_complete, sparse_columns
from gablework.operators.shape import conform_schema, derive, feature_columns, move_last, numeric_columns, total_of
from gablework.plans.recipes import Inputs
from gablework.sources.delimited import apply_types, infer_types, read_text
from gablework.sources.scratch import materialize

# ---- Fixed values: column roles of the house-sale files ----------------------------
ZERO_MEANS_ABSENT = [
    "MasVnrArea", "BsmtFinSF2", "BsmtFullBath", "BsmtHalfBath", "BsmtUnfSF", "TotalBsmtSF", "BsmtFinSF1",
    "GarageCars", "GarageArea",
]
MEAN_FILLED = ["LotFrontage"]
MEDIAN_FILLED = ["GarageYrBlt"]
CARRIED_FORWARD = [
    "Electrical", "SaleType", "KitchenQual", "Exterior1st", "Exterior2nd", "Functional", "Utilities",
    "MSZoning",
]
AREAS = ["TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "GrLivArea", "GarageArea"]
REPLACED = [*AREAS, "FullBath", "HalfBath", "YearRemodAdd", "YearBuilt"]

# Neighborhoods from cheapest to dearest; the code is the place, starting at 1.
NEIGHBORHOODS = [
    "BrDale", "MeadowV", "BrkSide", "IDOTRR", "Blueste", "Edwards", "OldTown", "NPkVill", "SWISU", "Sawyer",
    "NAmes", "Mitchel", "Blmngtn", "SawyerW", "NWAmes", "Gilbert", "CollgCr", "Somerst", "Crawfor", "ClearCr",
    "Veenker", "Timber", "NridgHt", "StoneBr", "NoRidge",
]

# Modelling table: name, type, source column.
MODEL_COLUMNS = [
    ("TipoDeVienda", "int", "MSSubClass"),
    ("LongitudDeLaCalle", "float", "LotFrontage"),
    ("AreaDelTerreno", "int", "LotArea"),
    ("Barrio", "int", "Neighborhood"),
    ("CalidadDeLaVivienda", "int", "OverallQual"),
    ("CondicionesDeLaVivienda", "int", "OverallCond"),
    ("PiesCuadradosDeFachada", "float", "MasVnrArea"),
    ("PiesCuadradosDeSotanoTerminados", "float", "BsmtFinSF1"),
    ("PiesCuadradosDeSotano2Terminados", "float", "BsmtFinSF2"),
    ("PiesCuadradosDeSotanoNoTerminados", "float", "BsmtUnfSF"),
    ("PiesCuadradosDeBajaCalidad", "int", "LowQualFinSF"),
    ("BaniosEnterosEnSotano", "float", "BsmtFullBath"),
    ("BaniosPequeniosEnSotano", "float", "BsmtHalfBath"),
    ("DormitoriosSobreSuelo", "int", "BedroomAbvGr"),
    ("CocinasSobresSuelo", "int", "KitchenAbvGr"),
    ("habitacionesSobreSueloNoBanios", "int", "TotRmsAbvGrd"),
    ("Chimeneas", "int", "Fireplaces"),
    ("AnioDeConstruccionDelGaraje", "float", "GarageYrBlt"),
    ("CochesDelGaraje", "float", "GarageCars"),
    ("PiesCuadradosDeTerrazaDeMaderaSobreSuelo", "int", "WoodDeckSF"),
    ("PiesCuadradosDePorcheAbierto", "int", "OpenPorchSF"),
    ("PiesCuadradosDePorcheCerrado", "int", "EnclosedPorch"),
    ("PorcheThreeSeasson", "int", "3SsnPorch"),
    ("PorcheAcristalado", "int", "ScreenPorch"),
    ("AreaDePiscina", "int", "PoolArea"),
    ("PrecioDeLosMiscelaneos", "int", "MiscVal"),
    ("MesDeVenta", "int", "MoSold"),
    ("AnioDeVenta", "int", "YrSold"),
    ("AreaHabitableTotal", "float", "TotalArea"),
    ("Banios", "float", "Bathrooms"),
    ("EdadMediaCasa", "float", "YearAverage"),
    ("PrecioDeLaVivenda", "float", "PrecioVenta"),
]
LABEL = "PrecioDeLaVivenda"
DISCRETIZED = "PiesCuadradosDeFachada"
# ------------------------------------------------------------------------------------

KEY = ["source_rank", "Id"]


def load_houses(spark: SparkSession, train: str, test: str, target: str) -> DataFrame:
    """Both files stacked, the test rows with the target file's prices, typed in one pass."""
    files = [read_text(spark, train), read_text(spark, test), read_text(spark, target, names=["Id", "SalePrice"])]
    # Keys meet as values, so " 2" and "02" are 2; their type is that of all three files.
    key_type = infer_types(reduce(DataFrame.union, [f.select("Id") for f in files])).fields[0].dataType
    train_rows, test_rows, prices = (f.withColumn("Id", F.col("Id").try_cast(key_type).cast("string")) for f in files)
    text = stack({"train": train_rows, "test": attach_target(test_rows, prices, "Id")})
    data = text.drop("source", "source_rank")
    types = infer_types(data)
    typed = apply_types(text, StructType([*types.fields, text.schema["source"], text.schema["source_rank"]]))
    # Cleaning makes several passes; they should not parse the text again.
    return materialize(typed, "houses")


def observed_columns(houses: DataFrame, fit_scope: str = "all") -> DataFrame:
    """All rows without the columns that are sparse in the rows of the scope."""
    scope = houses if fit_scope == "all" else houses.filter(F.col("source") == "train")
    return houses.drop(*sparse_columns(scope))


def clean_houses(houses: DataFrame, fit_scope: str = "all") -> DataFrame:
    """Impute and derive; text columns stay, complete."""
    kept = fill_zero(observed_columns(houses, fit_scope), ZERO_MEANS_ABSENT)
    scope = kept if fit_scope == "all" else kept.filter(F.col("source") == "train")
    filled = fit_fills(scope, mean=MEAN_FILLED, median=MEDIAN_FILLED).apply(kept)
    carried = fill_along(filled, CARRIED_FORWARD, KEY)
    derived = derive(
        fill_literal(carried),
        {
            "TotalArea": total_of(*AREAS),
            "Bathrooms": F.col("FullBath") + F.col("HalfBath") * 0.5,
            "YearAverage": (F.col("YearRemodAdd") + F.col("YearBuilt")) / 2,
        },
        drop=REPLACED,
    )
    return move_last(derived, "SalePrice", "PrecioVenta")


def encode_neighborhood(clean: DataFrame, learned: bool = False, fit_scope: str = "all") -> DataFrame:
    """Codes from the fixed ranking, or from this data's own mean prices."""
    if not learned:
        codes = {name: place for place, name in enumerate(NEIGHBORHOODS, start=1)}
        return encode_mapping(clean, "Neighborhood", codes)
    scope = clean if fit_scope == "all" else clean.filter(F.col("source") == "train")
    return fit_target_order(scope, "Neighborhood", "PrecioVenta").apply(clean)


def model_schema(narrow: bool = False) -> tuple[StructType, dict[str, str]]:
    """The 32 non-null columns and where each comes from; ``narrow`` keeps 4-byte floats."""
    ddl = ", ".join(f"{n} {t if narrow or t != 'float' else 'double'} NOT NULL" for n, t, _ in MODEL_COLUMNS)
    return _parse_datatype_string(ddl), {name: source for name, _, source in MODEL_COLUMNS}


def model_table(encoded: DataFrame, narrow: bool = False, check: bool = False) -> DataFrame:
    """The row key and the modelling columns, by name.

    Nulls raise while rows flow; with ``check`` the rows are written and counted on the way, for a
    message that names every offending column.
    """
    schema, sources = model_schema(narrow)
    numeric = encoded.select(*[f"`{c}`" for c in numeric_columns(encoded)])
    if check:
        numeric = require_complete(numeric, list(sources.values()))
    key = StructType([numeric.schema[c] for c in KEY])
    return conform_schema(numeric, StructType([*key.fields, *schema.fields]), sources)


def prepare_houses(
    spark: SparkSession, train: str, test: str, target: str, fit_scope: str = "all", learned_codes: bool = False
) -> DataFrame:
    clean = clean_houses(load_houses(spark, train, test, target), fit_scope)
    return model_table(encode_neighborhood(clean, learned_codes, fit_scope))


def house_inputs(table: DataFrame, **choices) -> Inputs:
    """Recipe inputs over the 31 features."""
    return Inputs(columns=feature_columns(table, LABEL, KEY), label=LABEL, discretize=DISCRETIZED, **choices)
