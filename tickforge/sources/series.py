"""Indicator series sources: series map config, landed rows, wide form, stacking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.dates import BR_DATE, try_parse_date_text
from tickforge.functions.numeric import tolerant_double

# Default series map (name -> code), in the documented order.
DEFAULT_SERIES = {
    "selic": 1178,
    "cdi": 12,
    "ipca": 433,
    "poupanca": 195,
    "igpm": 189,
    "inpc": 188,
    "igpdi": 190,
    "selic_meta": 432,
}

# Largest series map joined by broadcast (checked by a count before joining).
MAX_MAP_ENTRIES = 10_000


def map_size(json_text: str) -> int:
    """Entry count of a series-map config text (driver side, config only)."""
    import json
    return len(json.loads(json_text))


def series_map(spark: SparkSession, json_text: str) -> DataFrame:
    """``{"name": code, ...}`` text -> DataFrame(serie, code)."""
    m = F.from_json(F.lit(json_text), "map<string,int>")
    return spark.range(1).select(F.explode(m).alias("serie", "code"))


def label_series(rows: DataFrame, mapping: DataFrame, code: str = "code",
                 max_broadcast: int = MAX_MAP_ENTRIES, known_size: int | None = None) -> DataFrame:
    """Attach the series name to landed rows by code; an unknown code keeps
    its code as the name.

    The mapping normally comes from one config string. It is broadcast only
    when it has at most ``max_broadcast`` entries: ``known_size`` (e.g. the
    entry count of the config text) or else a count over the config-sized
    frame; a larger mapping goes through a shuffle join.
    """
    m = mapping.select(F.col("code").alias("__code"), F.col("serie").alias("__name"))
    size = known_size if known_size is not None else m.limit(max_broadcast + 1).count()
    if size <= max_broadcast:
        m = F.broadcast(m)
    joined = rows.join(m, rows[code] == m["__code"], "left")
    return joined.withColumn("serie", F.coalesce(F.col("__name"), F.col(code).cast("string"))) \
                 .drop("__code", "__name")


def typed_series(rows: DataFrame, date: str = "data", value: str = "valor",
                 date_fmt: str = BR_DATE) -> DataFrame:
    """Landed text rows -> (data timestamp, valor double, serie), bad -> NULL."""
    return rows.withColumn(date, try_parse_date_text(date, date_fmt)) \
               .withColumn(value, tolerant_double(F.col(value)))


def series_wide(df: DataFrame, names: list[str], date: str = "ref_date",
                serie: str = "idx_type", value: str = "idx_value") -> DataFrame:
    """Long -> wide: one row per date, one column per series name.

    ``names`` is required: passing the pivot values skips Spark's extra
    distinct job and fixes the output schema. One value per (date, series) is
    expected; ``max`` makes a repeated landing deterministic.
    """
    return df.groupBy(date).pivot(serie, names).agg(F.max(value))


def stack(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name (missing columns become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
