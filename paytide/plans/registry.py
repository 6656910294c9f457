"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from paytide.plans.views import Views
from paytide.session import prepare

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles for comparison: each is an exact decimal until this last step."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(QUERIES[name](Views(prepare(spark), sf_dir)))
