"""Table schemas and readers. Every read names its schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ``events.ts`` and ``orders.o_orderdate`` are stored without a zone and mean UTC, so they
# are read as TIMESTAMP: filters on them then reach the Parquet reader.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}

RAW_SCHEMA = (
    "external_id STRING, tx_id BIGINT, created_at TIMESTAMP, settled_at TIMESTAMP, "
    "type STRING, status STRING, amount DECIMAL(18,2), currency STRING, "
    "source_institution STRING, destination_institution STRING, source_account_id BIGINT, "
    "destination_account_id BIGINT, settlement_seconds DOUBLE, metadata STRING, "
    "_version BIGINT, _is_deleted INT, _ingested_at TIMESTAMP, yyyymm INT"
)

# Versioned rows as they lie in a table, under the batch of the job that wrote them.
STORED_SCHEMA = f"{RAW_SCHEMA}, writer STRING, batch_id BIGINT"

STATUSES = ("pending", "settled", "failed", "reversed")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")
