"""Change events: stream source, envelope parsing and the dead-letter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import month_key

# Fixed reasons, in the order the checks apply.
REASONS = (
    "invalid JSON",
    "envelope is not an object",
    "payload missing or not an object",
    "op missing",
    "row image missing",
    "invalid amount",
    "invalid timestamp",
    "invalid updated_at",
    "no version",
    "invalid id",
    "missing field",
    "invalid account id",
)


def kafka_source(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """Change topic from the earliest offset; offsets live in the query's checkpoint.

    A trigger takes all there is unless ``per_trigger`` bounds it.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select("value")


def file_source(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Change events as JSON lines landing in a folder, one event per line."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select(F.col("value"))
    )


def _iso_time(text: Column) -> Column:
    """A full ISO date, with or without a time. The cast alone would also read a bare year
    or a bare time of day."""
    dated = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(dated, F.try_to_timestamp(text))


_IMAGE_FIELDS = (
    "id", "external_id", "amount", "currency", "status", "type", "source_institution",
    "destination_institution", "source_account_id", "destination_account_id", "created_at",
    "settled_at", "updated_at", "metadata",
)


_IMAGE = "struct<" + ",".join(f"{f}:string" for f in _IMAGE_FIELDS) + ">"
_ENVELOPES = (
    "array<struct<payload:struct<op:string,"
    f"before:{_IMAGE},after:{_IMAGE},source:struct<ts_ms:string>>>>"
)


def _once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """Add a column the optimizer computes once per row: filters on what is derived from it
    are not moved below a generator, so they cannot repeat the parse."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def parse_cdc(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One typed row per event plus ``_reason`` (null when the event is good).

    A delete is described by its ``before`` image, everything else by ``after``.
    The version is the row's change time in milliseconds, or the event's own time when
    the row carries none. Bad events never raise: each keeps its text and gets a reason.
    """
    texts = events.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("_text"))
    # inside an array, text after the first JSON value is an error instead of being ignored
    wrapped = F.concat(F.lit("["), F.col("_text"), F.lit("]"))
    parsed = _once(
        texts, F.from_json(wrapped, _ENVELOPES, {"allowSingleQuotes": "false"}), "_docs", "_text"
    )
    payload = F.when(F.size("_docs") == 1, F.col("_docs")[0]["payload"])
    # only events without a usable payload are looked at again, to say why
    doc = F.try_parse_json(wrapped)
    only = F.try_variant_get(doc, "$[0]", "variant")
    is_json = only.isNotNull() & F.try_variant_get(doc, "$[1]", "variant").isNull()
    is_object = F.coalesce(F.schema_of_variant(only).startswith("OBJECT"), F.lit(False))
    problem = F.when(
        payload.isNull(),
        F.when(~F.coalesce(is_json, F.lit(False)), REASONS[0])
        .when(~is_object, REASONS[1])
        .otherwise(REASONS[2]),
    )
    image = F.when(payload["op"] == "d", payload["before"]).otherwise(payload["after"])
    opened = _once(
        parsed,
        F.struct(
            problem.alias("problem"),
            payload["op"].alias("op"),
            payload["source"]["ts_ms"].try_cast("bigint").alias("ts_ms"),
            image.alias("row"),
        ),
        "_e",
        "_text",
    )

    def field(name: str) -> Column:
        return F.col(f"_e.row.{name}")

    def account(name: str) -> Column:
        return F.coalesce(field(name).try_cast("bigint"), F.lit(0).cast("bigint")).alias(name)

    def unreadable(name: str) -> Column:
        """No account is account 0, but an account that cannot be read is an error."""
        return field(name).isNotNull() & field(name).try_cast("bigint").isNull()

    has_update = F.coalesce(field("updated_at"), F.lit("")) != ""
    fields = opened.select(
        "_text",
        "_e",
        field("external_id").alias("external_id"),
        field("id").try_cast("bigint").alias("tx_id"),
        _iso_time(field("created_at")).alias("created_at"),
        _iso_time(field("settled_at")).alias("settled_at"),
        field("type").alias("type"),
        field("status").alias("status"),
        field("amount").try_cast("decimal(18,2)").alias("amount"),
        F.coalesce(field("currency"), F.lit("BRL")).alias("currency"),
        field("source_institution").alias("source_institution"),
        field("destination_institution").alias("destination_institution"),
        account("source_account_id"),
        account("destination_account_id"),
        F.coalesce(F.nullif(field("metadata"), F.lit("")), F.lit("{}")).alias("metadata"),
        F.when(has_update, F.unix_millis(_iso_time(field("updated_at"))))
        .otherwise(F.col("_e.ts_ms"))
        .alias("_version"),
        F.when(F.col("_e.op") == "d", 1).otherwise(0).alias("_is_deleted"),
    )
    checks = (
        F.col("_e.op").isNull(),
        F.col("_e.row").isNull(),
        F.col("amount").isNull(),
        F.col("created_at").isNull()
        | (field("settled_at").isNotNull() & F.col("settled_at").isNull()),
        F.col("_version").isNull() & has_update,
        F.col("_version").isNull(),
        F.col("tx_id").isNull(),
        F.col("external_id").isNull()
        | F.col("type").isNull()
        | F.col("status").isNull()
        | F.col("source_institution").isNull()
        | F.col("destination_institution").isNull(),
        unreadable("source_account_id") | unreadable("destination_account_id"),
    )
    reason = F.coalesce(
        F.col("_e.problem"),
        *[F.when(c, F.lit(r)) for c, r in zip(checks, REASONS[3:], strict=True)],
    )
    return fields.select(
        "external_id",
        "tx_id",
        "created_at",
        "settled_at",
        "type",
        "status",
        "amount",
        "currency",
        "source_institution",
        "destination_institution",
        "source_account_id",
        "destination_account_id",
        ((F.unix_millis("settled_at") - F.unix_millis("created_at")) / F.lit(1000.0)).alias(
            "settlement_seconds"
        ),
        "metadata",
        "_version",
        "_is_deleted",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
        month_key("created_at").alias("yyyymm"),
        reason.alias("_reason"),
        "_text",
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_reason").isNull()).drop("_reason", "_text")


def split_dlq(parsed: DataFrame) -> DataFrame:
    """Dead letters: the untouched event text and the reason it was refused."""
    return parsed.filter(F.col("_reason").isNotNull()).select(
        F.col("_text").alias("value"), F.col("_reason").alias("reason")
    )


def envelope(rows: DataFrame, op: Column, ts_ms: Column) -> DataFrame:
    """Wrap transaction rows as change events (JSON text in ``value``)."""
    image = F.struct(
        "id",
        "external_id",
        F.col("amount").cast("string").alias("amount"),
        "currency",
        "status",
        "type",
        "source_institution",
        "destination_institution",
        "source_account_id",
        "destination_account_id",
        *[
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
            for c in ("created_at", "settled_at", "updated_at")
        ],
        "metadata",
    )
    payload = F.struct(
        op.alias("op"),
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.struct(ts_ms.alias("ts_ms")).alias("source"),
    )
    return rows.withColumn("value", F.to_json(F.struct(payload.alias("payload"))))
