"""The data contract: names, lists and limits shared by every stage.

All values below are fixed values of the campaign table. They have to equal
the ones the data and its consumers use, so they are stated plainly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

TARGET = "FLAG_VENTA"
MONTH = "MES"
CUSTOMER = "CLIENTE"

# Delimited file format.
CSV_SEPARATOR = ";"
CSV_ENCODING = "UTF-8"

# The 22 columns of the raw table, in file order, with Spark types.
RAW_COLUMNS = {
    "MES": "bigint",
    "CLIENTE": "bigint",
    "LINEA_RENOVADO": "bigint",
    "PLAZO_RENOVADO": "bigint",
    "FLAG_VENTA": "bigint",
    "USO_LINEA_TOTAL_TC_T2": "double",
    "USO_TRIM_LINEA_BBVA": "double",
    "NR_ENTIDADES_TOTAL_T2": "bigint",
    "DIFF_NRO_ENTIDA_TOTALES_T2_T12": "bigint",
    "SDO_CONSUMO_T2": "double",
    "RESENCIA_OFERTA_PLD_RENOVADO": "double",
    "Ahorro_Sldo_Bco_T1": "bigint",
    "PConsumo_Sldo_Bco_T1": "bigint",
    "SDO_BCO_tot_sm_pasivo_Bco_6M": "double",
    "EDAD": "double",
    "SEXO": "string",
    "EST_CIVIL": "string",
    "ANTIGUEDAD_MES": "double",
    "REGION": "string",
    "FLAG_LIMA_PROVINCIA": "bigint",
    "SUELDO_ESTIMADO": "double",
    "CUBRIR_DEUDA_CONSUMO_SF_RENOVA_PLD": "double",
}

# Raw name -> analysis name.
RENAMES = {
    "LINEA_RENOVADO": "Linea_Renovado",
    "PLAZO_RENOVADO": "Plazo_Renovado",
    "USO_LINEA_TOTAL_TC_T2": "Uso_Linea",
    "USO_TRIM_LINEA_BBVA": "Uso_TrimLinea",
    "NR_ENTIDADES_TOTAL_T2": "Nro_Entidades",
    "DIFF_NRO_ENTIDA_TOTALES_T2_T12": "Dif_Entidades",
    "SDO_CONSUMO_T2": "Saldo_Consumo",
    "RESENCIA_OFERTA_PLD_RENOVADO": "Meses_oferta",
    "Ahorro_Sldo_Bco_T1": "Ahorro",
    "PConsumo_Sldo_Bco_T1": "Prestamo_vigente",
    "SDO_BCO_tot_sm_pasivo_Bco_6M": "Promed_6Mdeuda",
    "FLAG_LIMA_PROVINCIA": "Flag_LimProv",
    "CUBRIR_DEUDA_CONSUMO_SF_RENOVA_PLD": "Deuda_Cubierta%",
}

# Texts that mean "missing" in a delimited file (pandas' documented defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns get which treatment when the feature table is built.

    The defaults are fixed values of the campaign table. ``key`` names the
    columns that identify a row; random draws are hashes of them.
    """

    target: str = TARGET
    key: tuple[str, ...] = (MONTH, CUSTOMER)
    seed: int = 42
    floor_at_zero: tuple[str, ...] = ("Ahorro", "Prestamo_vigente", "Promed_6Mdeuda")
    log: tuple[str, ...] = (
        "Uso_Linea", "Uso_TrimLinea", "Saldo_Consumo", "SUELDO_ESTIMADO", "ANTIGUEDAD_MES",
        "Linea_Renovado", "Ahorro", "Prestamo_vigente", "Promed_6Mdeuda", "Deuda_Cubierta%",
    )
    impute_uniform: tuple[str, ...] = ("Uso_TrimLinea_LOG", "Uso_Linea_LOG", "Meses_oferta")
    impute_median: tuple[str, ...] = (
        "Saldo_Consumo_LOG", "SUELDO_ESTIMADO_LOG", "ANTIGUEDAD_MES_LOG", "EDAD",
    )
    categorical: tuple[str, ...] = ("REGION", "SEXO", "EST_CIVIL")
    drop: tuple[str, ...] = (
        "CLIENTE", "Uso_Linea", "Uso_TrimLinea", "Saldo_Consumo", "SUELDO_ESTIMADO",
        "ANTIGUEDAD_MES", "Linea_Renovado", "Ahorro", "Prestamo_vigente", "Promed_6Mdeuda",
        "Deuda_Cubierta%",
    )
    unknown_level: str = "DESCONOCIDO"
    max_levels: int | None = None  # an optional check; no limit by default

    @property
    def numeric(self) -> list[str]:
        """Columns coerced to double, first mention first."""
        names = self.floor_at_zero + self.log + self.impute_median + self.impute_uniform
        return list(dict.fromkeys(names))


# Split, oversampling and search settings.
TEST_SIZE = 0.30
N_FOLDS = 3
SMOTE_NEIGHBOURS = 5
SMOTE_RATIO = 0.30
THRESHOLD = 0.50
SEED = 42
SEARCH_METRICS = ("roc_auc", "f1", "recall", "precision")
SELECTION_METRIC = "roc_auc"

# Minimum metrics of the quality gate.
GATE_MINIMUMS = {"recall": 0.65, "roc_auc": 0.65, "f1": 0.60}

# Metrics and parameters written to the run ledger.
LEDGER_METRICS = (
    "accuracy", "precision", "recall", "f1", "roc_auc",
    "cv_best_score", "threshold", "n_train", "n_test", "n_features",
)
EXPERIMENT_NAME = "campaign_response"
REGISTERED_MODEL_NAME = "campaign_response_model"


@dataclass(frozen=True)
class ModelSpec:
    """A model family and its parameter grid, in search order."""

    name: str
    grid: dict[str, tuple] = field(default_factory=dict)


# The candidate families and their grids. ``None`` depth = no limit.
MODEL_SPECS = (
    ModelSpec("decision_tree", {
        "max_depth": (4, 6, 8, None),
        "min_samples_split": (2, 10),
        "criterion": ("gini", "entropy"),
    }),
    ModelSpec("random_forest", {
        "n_estimators": (100, 200),
        "max_depth": (6, 10),
        "min_samples_split": (5,),
    }),
)

# The optional boosted family, off by default.
BOOSTED_SPEC = ModelSpec("boosted_trees", {
    "n_estimators": (200, 400),
    "max_depth": (3, 5),
    "learning_rate": (0.05, 0.10),
    "subsample": (0.8,),
    "colsample_bytree": (0.8,),
})
