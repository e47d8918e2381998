"""Table contracts: schemas, layer registry and schema checks.

Covers the registry and naming helpers (:func:`table_spec` is the metadata of a table), the
required-columns check, empty frames with a schema and table properties.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column contracts of each layer (names and order are part of
# the data contract and must stay as written).
# ---------------------------------------------------------------------------
BRONZE_QUOTES = T.StructType([
    T.StructField("Date", T.TimestampType(), False),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Volume", T.DoubleType(), True),
    T.StructField("Dividends", T.DoubleType(), True),
    T.StructField("Stock_Splits", T.DoubleType(), True),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("ingestion_timestamp", T.TimestampType(), False),
])

BRONZE_SERIES = T.StructType([
    T.StructField("data", T.TimestampType(), False),
    T.StructField("valor", T.DoubleType(), False),
    T.StructField("serie", T.StringType(), False),
    T.StructField("ingestion_timestamp", T.TimestampType(), False),
])

SILVER_EQUITY = T.StructType([
    T.StructField("trade_date", T.TimestampType(), True),
    T.StructField("open_price", T.DoubleType(), True),
    T.StructField("high_price", T.DoubleType(), True),
    T.StructField("low_price", T.DoubleType(), True),
    T.StructField("close_price", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("div_cash", T.DoubleType(), True),
    T.StructField("split_ratio", T.DoubleType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("ingestion_timestamp", T.TimestampType(), True),
])

SILVER_MACRO = T.StructType([
    T.StructField("ref_date", T.TimestampType(), True),
    T.StructField("idx_value", T.DoubleType(), True),
    T.StructField("idx_type", T.StringType(), True),
    T.StructField("frequency", T.StringType(), True),
    T.StructField("ingestion_timestamp", T.TimestampType(), True),
])

GOLD_EQUITY = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("avg_return", T.DoubleType(), True),
    T.StructField("volatility", T.DoubleType(), True),
    T.StructField("avg_price", T.DoubleType(), True),
    T.StructField("avg_volume", T.DoubleType(), True),
    T.StructField("last_update", T.TimestampType(), True),
])

GOLD_MACRO = T.StructType([
    T.StructField("idx_type", T.StringType(), True),
    T.StructField("ano", T.IntegerType(), True),
    T.StructField("mes", T.IntegerType(), True),
    T.StructField("ano_mes", T.StringType(), True),
    T.StructField("media_mensal", T.DoubleType(), True),
    T.StructField("minimo_mensal", T.DoubleType(), True),
    T.StructField("maximo_mensal", T.DoubleType(), True),
    T.StructField("variacao_mes_anterior", T.DoubleType(), True),
    T.StructField("primeira_data_mes", T.TimestampType(), True),
    T.StructField("ultima_data_mes", T.TimestampType(), True),
    T.StructField("num_medicoes", T.LongType(), False),
    T.StructField("last_update", T.TimestampType(), True),
    T.StructField("trend_6m", T.DoubleType(), False),
])

# Database of each layer where the caller names none.
DATABASES = {"bronze": "bronze", "prata": "silver", "ouro": "gold"}
# Other names of layers, and the quality label of each.
LAYER_ALIASES = {"silver": "prata", "gold": "ouro"}
LAYER_PROPERTIES = {"bronze": {"quality": "bronze"}, "prata": {"quality": "silver"}, "ouro": {"quality": "gold"}}


@dataclass(frozen=True)
class TableSpec:
    """What is known of a layer table without reading it."""

    layer: str
    key: str
    description: str
    alias: str
    expected_columns: tuple[str, ...]
    schema: T.StructType | None = None
    source: str | None = None
    properties: dict = field(default_factory=dict, hash=False, compare=False)

    def name_in(self, database: str | None = None) -> str:
        """Catalog name, in ``database`` or the layer's default one."""
        return f"{database or DATABASES[self.layer]}.{self.key}"


def _spec(layer, key, description, alias, columns, schema=None, source=None):
    return TableSpec(layer, key, description, alias, tuple(columns), schema, source, LAYER_PROPERTIES[layer])


# Table registry (keys, descriptions, aliases, expected columns).
TABLES: dict[str, dict[str, TableSpec]] = {
    "bronze": {
        "cotacoes_b3": _spec("bronze", "cotacoes_b3", "Cotações brutas da B3 (Yahoo Finance)",
                             "Cotações B3",
                             ["Date", "Open", "High", "Low", "Close", "Volume", "Dividends",
                              "Stock_Splits", "ticker"], BRONZE_QUOTES),
        "series_bacen": _spec("bronze", "series_bacen", "Séries temporais do BACEN (SGS)",
                              "Indicadores BACEN", ["data", "valor", "serie"], BRONZE_SERIES),
    },
    "prata": {
        "tb_mkt_eqt_day": _spec("prata", "tb_mkt_eqt_day", "Série histórica diária de equity",
                                "Equity Diário",
                                ["trade_date", "open_price", "high_price", "low_price",
                                 "close_price", "volume", "div_cash", "split_ratio", "symbol"],
                                SILVER_EQUITY, "cotacoes_b3"),
        "tb_mkt_idx_eco": _spec("prata", "tb_mkt_idx_eco", "Indicadores econômicos padronizados",
                                "Índices Econômicos",
                                ["ref_date", "idx_value", "idx_type", "frequency"],
                                SILVER_MACRO, "series_bacen"),
    },
    "ouro": {
        "tb_mkt_eqt_perf": _spec("ouro", "tb_mkt_eqt_perf", "Análise de performance de equity",
                                 "Performance de Ativos",
                                 ["symbol", "monthly_return", "volatility", "avg_price",
                                  "avg_volume", "last_update"], GOLD_EQUITY, "tb_mkt_eqt_day"),
        "tb_mkt_idx_dash": _spec("ouro", "tb_mkt_idx_dash", "Dashboard de indicadores macroeconômicos",
                                 "Dashboard Macro",
                                 ["idx_type", "current_value", "mtd_change", "ytd_change",
                                  "trend_6m", "last_update"], GOLD_MACRO, "tb_mkt_idx_eco"),
    },
}


def table_spec(layer: str, name: str) -> TableSpec:
    """The entry of a table; unknown layers and tables raise."""
    tables = TABLES.get(LAYER_ALIASES.get(layer, layer))
    if tables is None or name not in tables:
        known = ", ".join(f"{a}.{t}" for a, ts in TABLES.items() for t in ts)
        raise ValueError(f"no table {layer}.{name}; known: {known}")
    return tables[name]


def table_name(layer: str, name: str, with_schema: bool = True, database: str | None = None) -> str:
    spec = table_spec(layer, name)
    return spec.name_in(database) if with_schema else spec.key


def missing_columns(df: DataFrame, required) -> list[str]:
    names = required.fieldNames() if isinstance(required, T.StructType) else list(required)
    have = set(df.columns)
    return [c for c in names if c not in have]


def require_columns(df: DataFrame, required, ignore=("ingestion_timestamp",)) -> DataFrame:
    """Fail before running anything if a required column is absent."""
    names = required.fieldNames() if isinstance(required, T.StructType) else list(required)
    missing = [c for c in missing_columns(df, [n for n in names if n not in ignore])]
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df


def contract_diff(df: DataFrame, spec: TableSpec) -> dict[str, list[str]]:
    """Compare a frame's columns with the registry's expected columns
    (metadata only): ``missing`` expected but absent, ``extra`` present but
    not expected. The registry's gold lists differ from what gold computes;
    this makes that visible instead of silent."""
    have, want = list(df.columns), list(spec.expected_columns)
    return {"missing": [c for c in want if c not in have],
            "extra": [c for c in have if c not in want]}


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder / cast columns to ``schema`` by name (Spark's ``DataFrame.to``).

    Nullability is not enforced by ``to`` for nullable inputs; non-null key
    columns are checked by :func:`tickforge.operators.quality.not_null_checks`.
    """
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return df.to(relaxed)
