"""Registered queries: filters, derived columns, rules and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from paytide.functions.timing import (
    aligned_cut,
    as_of,
    boundary_minutes,
    boundary_seconds,
    last,
    micros_between,
    month_key,
    seconds_between,
    tumbling,
)
from paytide.operators import quality
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import TYPES, Views


@query(
    "trailing_window",
    sql(
        "tx anchor",
        """SELECT w.label AS label, count(*) AS n_rows, min(created_at) AS first_at
        FROM tx, anchor, (VALUES ('24 hours', INTERVAL 24 HOUR), ('48 hours', INTERVAL 48 HOUR),
             ('7 days', INTERVAL 7 DAY), ('20 days', INTERVAL 20 DAY)) w(label, span)
        WHERE created_at >= as_of - span GROUP BY 1""",
    ),
)
def trailing_window(v: Views):
    """Rows in each trailing window, all windows counted in one pass."""
    spans = ["24 hours", "48 hours", "7 days", "20 days"]
    inside = [F.when(last("created_at", s, v.as_of), F.lit(s)) for s in spans]
    widest = v.tx.filter(last("created_at", spans[-1], v.as_of))
    labelled = widest.select("created_at", F.explode(F.array_compact(F.array(*inside))).alias("label"))
    return labelled.groupBy("label").agg(
        F.count("*").alias("n_rows"), F.min("created_at").alias("first_at")
    )


@query("as_of_anchor", "SELECT max(ts) AS as_of FROM events")
def as_of_anchor(v: Views):
    return v.tx.agg(F.coalesce(F.max("created_at"), F.current_timestamp()).alias("as_of"))


@query(
    "aligned_cutoff",
    sql(
        "anchor",
        """SELECT date_trunc('hour', as_of - INTERVAL 20 DAY) AS by_hour,
          date_trunc('day', as_of - INTERVAL 20 DAY) AS by_day,
          (SELECT count(*) FROM events WHERE ts >= date_trunc('hour', as_of - INTERVAL 20 DAY)) AS n_hour,
          (SELECT count(*) FROM events WHERE ts >= date_trunc('day', as_of - INTERVAL 20 DAY)) AS n_day
        FROM anchor""",
    ),
)
def aligned_cutoff(v: Views):
    hour, day = (aligned_cut(v.as_of, "20 days", u) for u in ("hour", "day"))
    return v.tx.agg(
        F.max(hour).alias("by_hour"),
        F.max(day).alias("by_day"),
        F.count_if(F.col("created_at") >= hour).alias("n_hour"),
        F.count_if(F.col("created_at") >= day).alias("n_day"),
    )


@query(
    "recon_divergent_share",
    sql(
        "recon",
        """SELECT count(*) AS n_rows, count(*) FILTER (WHERE abs(difference) > 0.01) AS divergent,
          100.0::DOUBLE * count(*) FILTER (WHERE abs(difference) > 0.01) / count(*) AS pct
        FROM (SELECT amount_received - amount_expected AS difference FROM recon)""",
    ),
)
def recon_divergent_share(v: Views):
    off = F.abs("difference") > F.lit("0.01").cast("decimal(3,2)")
    return v.recon.agg(F.count("*").alias("n_rows"), F.count_if(off).alias("divergent")).select(
        "*", (F.lit(100.0) * F.col("divergent") / F.col("n_rows")).alias("pct")
    )


@query(
    "derived_columns",
    sql(
        "tx recon",
        """SELECT t.id, t.settlement_seconds, CAST(r.amount_received - r.amount_expected AS DOUBLE) AS difference
        FROM tx t LEFT JOIN recon r ON r.transaction_id = t.id""",
    ),
)
def derived_columns(v: Views):
    millis = F.unix_millis("settled_at") - F.unix_millis("created_at")
    tx = v.tx.select("id", (millis / F.lit(1000.0)).alias("settlement_seconds"))
    recon = v.recon.select(F.col("transaction_id").alias("id"), "difference")
    return tx.join(recon, "id", "left")


@query(
    "dq_violations",
    sql(
        "tx anchor",
        """c AS (SELECT
          count(*) FILTER (WHERE amount <= 0) AS amount_not_positive,
          count(*) FILTER (WHERE settled_at < created_at) AS settled_before_created,
          count(*) FILTER (WHERE status NOT IN ('pending','settled','failed','reversed')) AS status_out_of_domain,
          count(*) FILTER (WHERE type NOT IN ('click','view','purchase','signup')) AS type_out_of_domain,
          count(*) FILTER (WHERE external_id IS NULL) AS external_id_missing,
          count(*) FILTER (WHERE created_at IS NULL) AS created_at_missing,
          count(*) FILTER (WHERE source_account_id IS NULL AND destination_account_id IS NULL) AS no_account,
          count(*) FILTER (WHERE created_at > as_of) AS created_in_future,
          count(*) FILTER (WHERE settled_at > as_of) AS settled_in_future
          FROM tx, anchor)
        SELECT * FROM (UNPIVOT c ON COLUMNS(*) INTO NAME rule VALUE violations)""",
    ).replace("SELECT * FROM (UNPIVOT", "SELECT rule, violations FROM (UNPIVOT"),
)
def dq_violations(v: Views):
    return quality.violations(v.tx, quality.transaction_rules(v.as_of, TYPES[:4]))


@query(
    "dq_unique_accounts",
    sql(
        "accounts",
        """SELECT institution_code, status, count(*) AS n FROM accounts GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
)
def dq_unique_accounts(v: Views):
    return quality.repeated_keys(v.accounts, ["institution_code", "status"])


@query(
    "dq_unique_account_numbers",
    sql(
        "accounts",
        """SELECT institution_code, account_number, count(*) AS n FROM accounts
        GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
)
def dq_unique_account_numbers(v: Views):
    return quality.repeated_keys(v.accounts, ["institution_code", "account_number"])


@query(
    "dq_field_presence",
    sql(
        "tx",
        """SELECT status, count(*) AS n_rows, count(settled_at) AS with_settlement,
          count(*) FILTER (WHERE settled_at IS NULL) AS without_settlement,
          count(*) FILTER (WHERE updated_at IS DISTINCT FROM settled_at) AS distinct_update
        FROM tx GROUP BY 1""",
    ),
)
def dq_field_presence(v: Views):
    return v.tx.groupBy("status").agg(
        F.count("*").alias("n_rows"),
        F.count("settled_at").alias("with_settlement"),
        F.count_if(F.col("settled_at").isNull()).alias("without_settlement"),
        F.count_if(~F.col("updated_at").eqNullSafe(F.col("settled_at"))).alias("distinct_update"),
    )


@query(
    "pii_column_scan",
    sql(
        "accounts",
        """c AS (SELECT count(account_number) AS account_number, count(holder_document) AS holder_document,
             count(holder_name) AS holder_name FROM accounts)
        SELECT 'accounts' AS table_name, column_name, n_values
        FROM (UNPIVOT c ON COLUMNS(*) INTO NAME column_name VALUE n_values)""",
    ),
)
def pii_column_scan(v: Views):
    tables = {"tx": v.tx, "raw": v.raw, "funnel": v.funnel, "accounts": v.accounts}
    return quality.pii_columns(v.spark, tables)


@query(
    "scalar_time_bucket",
    """SELECT event_id AS id, date_trunc('month', ts) AS by_month, date_trunc('hour', ts) AS by_hour,
      time_bucket(INTERVAL '15 minutes', ts) AS by_quarter, CAST(ts AS DATE) AS day,
      CAST(strftime(ts, '%Y%m') AS INTEGER) AS yyyymm, CAST(hour(ts) AS INTEGER) AS hour_of_day,
      date_trunc('week', ts) AS by_week
    FROM events""",
)
def scalar_time_bucket(v: Views):
    at = F.col("created_at")
    return v.tx.select(
        "id",
        F.date_trunc("month", at).alias("by_month"),
        F.date_trunc("hour", at).alias("by_hour"),
        tumbling(at, "15 minutes").alias("by_quarter"),
        F.to_date(at).alias("day"),
        month_key(at).alias("yyyymm"),
        F.hour(at).alias("hour_of_day"),
        F.date_trunc("week", at).alias("by_week"),
    )


@query(
    "scalar_time_diff",
    sql(
        "tx anchor",
        """SELECT id, epoch_us(settled_at) - epoch_us(created_at) AS micros,
          CAST(settle_ms AS DOUBLE) / 1000 AS seconds,
          (epoch_us(settled_at) // 1000) - (epoch_us(created_at) // 1000) AS millis,
          date_diff('second', created_at, settled_at) AS boundary_s,
          date_diff('minute', created_at, as_of) AS boundary_m
        FROM tx, anchor""",
    ),
)
def scalar_time_diff(v: Views):
    return v.tx.select(
        "id",
        micros_between("settled_at", "created_at").alias("micros"),
        seconds_between("settled_at", "created_at").alias("seconds"),
        (F.unix_millis("settled_at") - F.unix_millis("created_at")).alias("millis"),
        boundary_seconds("settled_at", "created_at").alias("boundary_s"),
        boundary_minutes(v.as_of, "created_at").cast("long").alias("boundary_m"),
    )


@query(
    "scalar_conditional",
    sql(
        "tx",
        """SELECT id, CASE WHEN amount >= 100 THEN 'high' WHEN amount >= 20 THEN 'mid' ELSE 'low' END AS band,
          coalesce(settled_at, created_at) AS effective_at, nullif(k, 0) AS k_or_null,
          if(status = 'settled', 1, 0) AS is_settled, CAST(abs(amount - 50) AS DOUBLE) AS off_fifty,
          status IS DISTINCT FROM 'settled' AS unsettled
        FROM tx""",
    ),
)
def scalar_conditional(v: Views):
    amount = F.col("amount")
    return v.tx.select(
        "id",
        F.when(amount >= 100, "high").when(amount >= 20, "mid").otherwise("low").alias("band"),
        F.coalesce("settled_at", "created_at").alias("effective_at"),
        F.nullif("k", F.lit(0)).alias("k_or_null"),
        F.when(F.col("status") == "settled", 1).otherwise(0).alias("is_settled"),
        F.abs(amount - 50).alias("off_fifty"),
        (~F.col("status").eqNullSafe(F.lit("settled"))).alias("unsettled"),
    )


@query(
    "scalar_string",
    sql(
        "accounts",
        """SELECT id, lpad(CAST(id AS VARCHAR), 8, '0') AS padded, holder_name || ' / ' || status AS label,
          trim('  ' || status || ' ') AS trimmed, printf('account %d (%s)', id, status) AS formatted,
          account_number LIKE '00000%' AS low_number
        FROM accounts""",
    ),
)
def scalar_string(v: Views):
    return v.accounts.select(
        "id",
        F.lpad(F.col("id").cast("string"), 8, "0").alias("padded"),
        F.concat("holder_name", F.lit(" / "), "status").alias("label"),
        F.trim(F.concat(F.lit("  "), "status", F.lit(" "))).alias("trimmed"),
        F.format_string("account %d (%s)", "id", "status").alias("formatted"),
        F.col("account_number").like("00000%").alias("low_number"),
    )


@query(
    "scalar_hash",
    sql(
        "accounts",
        """SELECT id, sha256(holder_document) AS document_hash,
          'ANON-' || sha256(CAST(id AS VARCHAR) || 'salt') AS alias, md5(holder_name) AS name_md5
        FROM accounts""",
    ),
)
def scalar_hash(v: Views):
    return v.accounts.select(
        "id",
        F.sha2("holder_document", 256).alias("document_hash"),
        F.concat(F.lit("ANON-"), F.sha2(F.concat(F.col("id").cast("string"), F.lit("salt")), 256)).alias(
            "alias"
        ),
        F.md5("holder_name").alias("name_md5"),
    )


@query(
    "scalar_json",
    sql(
        "tx",
        """SELECT id, k, '{"id":' || id || ',"status":"' || status || '"}' AS packed FROM tx""",
    ),
)
def scalar_json(v: Views):
    parsed = F.from_json("metadata", "k INT")
    return v.tx.select(
        "id", parsed["k"].alias("k"), F.to_json(F.struct("id", "status")).alias("packed")
    )


@query(
    "scalar_array",
    sql(
        "tx",
        """SELECT id, (['D+0', 'D+1', 'D+2'])[1 + CAST(k % 3 AS INTEGER)] AS settlement_window,
          type IN ('click', 'view') AS is_browse
        FROM tx""",
    ),
)
def scalar_array(v: Views):
    windows = F.array(F.lit("D+0"), F.lit("D+1"), F.lit("D+2"))
    return v.tx.select(
        "id",
        F.element_at(windows, (F.col("k") % 3 + 1).cast("int")).alias("settlement_window"),
        F.col("type").isin("click", "view").alias("is_browse"),
    )


@query(
    "freshness_minutes",
    sql(
        "raw anchor",
        """SELECT max(created_at) AS last_created_at,
          date_diff('minute', max(created_at), max(as_of) + INTERVAL 95 SECOND) AS minutes_behind
        FROM raw, anchor""",
    ),
)
def freshness_minutes(v: Views):
    from paytide.functions.timing import interval
    from paytide.operators.aggregates import freshness

    return freshness(v.raw, as_of(v.tx) + interval("95 seconds"))
