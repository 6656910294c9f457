"""Derived columns, row rules and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.sources.tables import STATUSES

# fixed value: personal-data column names that must not reach the analytical tables
PERSONAL_COLUMNS = (
    "holder_name", "holder_document", "document", "full_name", "email", "cpf", "cnpj",
    "account_number",
)


def with_difference(recon: DataFrame) -> DataFrame:
    return recon.withColumn("difference", F.col("amount_received") - F.col("amount_expected"))


def transaction_rules(now: Column, types: tuple[str, ...]) -> dict[str, Column]:
    """Rule name to the condition a bad row meets."""
    return {
        "amount_not_positive": F.col("amount") <= 0,
        "settled_before_created": F.col("settled_at") < F.col("created_at"),
        "status_out_of_domain": ~F.col("status").isin(*STATUSES),
        "type_out_of_domain": ~F.col("type").isin(*types),
        "external_id_missing": F.col("external_id").isNull(),
        "created_at_missing": F.col("created_at").isNull(),
        "no_account": F.col("source_account_id").isNull()
        & F.col("destination_account_id").isNull(),
        "created_in_future": F.col("created_at") > now,
        "settled_in_future": F.col("settled_at") > now,
    }


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all counted in one pass over the table."""
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def pii_columns(
    spark: SparkSession, tables: dict[str, DataFrame], deny: tuple[str, ...] = PERSONAL_COLUMNS
) -> DataFrame:
    """Columns whose names mark personal data, and how many values each holds.

    The schemas decide which tables are read at all: one with no such column costs nothing.
    """
    out = spark.createDataFrame([], "table_name STRING, column_name STRING, n_values BIGINT")
    for name, df in tables.items():
        hits = [c for c in df.columns if c.lower() in deny]
        if hits:
            counted = df.agg(*[F.count(c).alias(c) for c in hits])
            rows = counted.unpivot([], hits, "column_name", "n_values")
            out = out.unionByName(
                rows.select(F.lit(name).alias("table_name"), "column_name", "n_values")
            )
    return out
