"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finmarts.functions import rules
from finmarts.functions.numeric import flag

# Sales channels.
CHANNELS = [
    (1, "DIRECT", "Прямые продажи", "Sales"),
    (2, "ONLINE", "Интернет-магазин", "Digital"),
    (3, "MARKETPLACE", "Маркетплейс", "Digital"),
    (4, "PARTNER", "Партнёрская сеть", "Indirect"),
    (5, "TELESALES", "Телефонные продажи", "Sales"),
    (6, "FIELD", "Полевые продажи", "Sales"),
]
# Planning scenarios.
SCENARIOS = [
    (1, "ACTUAL", "Факт", 1),
    (2, "BUDGET", "Бюджет", 0),
    (3, "FORECAST", "Прогноз", 0),
    (4, "REFORECAST", "Перепрогноз", 0),
]


def _fixed_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as a local relation, typed by the schema."""
    columns = [part.split()[0] for part in schema.split(", ")]
    values = ", ".join(str(row) for row in rows)
    typed = [F.col(part.split()[0]).cast(part.split()[1]).alias(part.split()[0]) for part in schema.split(", ")]
    return spark.sql(f"select * from values {values} as fixed({', '.join(columns)})").select(*typed)


def channel(spark: SparkSession) -> DataFrame:
    rows = _fixed_rows(
        spark, CHANNELS, "channel_id int, channel_code string, channel_name string, channel_type string"
    )
    return rows.withColumn("is_digital", flag(F.col("channel_type") == "Digital"))


def scenario(spark: SparkSession) -> DataFrame:
    return _fixed_rows(spark, SCENARIOS, "scenario_id int, scenario_code string, scenario_name string, is_actual int")


def scenario_name(scenario_id: str = "scenario_id") -> Column:
    """Name of a scenario, null for an unknown one.

    The list has four fixed rows, so looking the name up in an expression replaces
    the left join to the scenario dimension.
    """
    name = F.lit(None).cast("string")
    for known, _, shown, _ in reversed(SCENARIOS):
        name = F.when(F.col(scenario_id) == known, shown).otherwise(name)
    return name.alias("scenario_name")


def account(ods: DataFrame) -> DataFrame:
    path = rules.account_path("statement_type", "pl_group", "bs_group", "cf_section")
    return ods.withColumn("full_account_path", path)


def client(ods: DataFrame) -> DataFrame:
    return ods.withColumn("ltv_tier", F.lit("unknown"))


def company(ods: DataFrame) -> DataFrame:
    return ods


def manager(ods: DataFrame) -> DataFrame:
    return ods


def supplier(ods: DataFrame) -> DataFrame:
    return ods


def product(ods: DataFrame) -> DataFrame:
    return ods.select(
        "*", flag(F.col("margin_group") == "high").alias("is_high_margin"), F.lit("unknown").alias("abc_class")
    )


def warehouse(ods: DataFrame) -> DataFrame:
    return ods.withColumn("is_primary", flag(F.col("warehouse_id") == 1))
